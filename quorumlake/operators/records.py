"""Small operators over members, meetings and feeds: terms, files, queues, enrichment, tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def terms_newest_first(members: DataFrame) -> DataFrame:
    """Members with their terms (role, start, end) in falling order of start, and the newest term's fields beside them."""
    order = F.reverse(F.array_sort(F.transform("terms", lambda t: F.struct(F.coalesce(t["start"], F.lit("")).alias("k"), t.alias("t")))))
    sorted_ = members.withColumn("terms", F.transform(order, lambda x: x["t"]))
    newest = F.get("terms", F.lit(0))
    return sorted_.withColumns({k: newest.getField(k) for k in ("role", "start", "end")})


def serving(terms: Column, day: Column) -> Column:
    """Whether one of the terms holds on the day; an open end counts, no terms at all count as serving."""
    return F.when(terms.isNull() | (F.size(terms) == 0), True).otherwise(F.exists(terms, lambda t: F.coalesce(t["start"] <= day, F.lit(True)) & F.coalesce(t["end"] >= day, F.lit(True))))


def first_seated(terms: Column) -> Column:
    return F.coalesce(F.array_min(F.transform(terms, lambda t: t["start"])), F.lit("9999"))


def role_run_start(terms: Column) -> Column:
    """The start of the unbroken run of the newest role, over terms from the newest on."""
    role = F.get(terms, F.lit(0))["role"]
    broken = F.filter(F.transform(terms, lambda t, i: F.when(~t["role"].eqNullSafe(role), i)), lambda i: i.isNotNull())
    return F.get(terms, F.coalesce(F.get(broken, F.lit(0)), F.size(terms)) - 1)["start"]


def most_frequent(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, n): the most frequent value of each key, ties to the smaller value."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), F.col(value))).alias("x")).select(key, "x.*")


def best_file(files: Column, kind: int) -> Column:
    """Of the published files of a kind the approved one, else the newest."""
    number = lambda f: F.left(F.regexp_replace(F.coalesce(f["publishOn"], F.lit("")), r"\D", ""), F.lit(14)).try_cast("bigint")
    ranked = F.array_sort(F.transform(F.filter(files, lambda f: f["fileType"] == kind), lambda f: F.struct((~F.lower(F.coalesce(f["name"], F.lit(""))).contains("approved")).cast("int").alias("a"), (-F.coalesce(number(f), F.lit(0))).alias("b"), f.alias("f"))))
    return F.get(ranked, F.lit(0))["f"]


def pending(events: DataFrame, done: DataFrame, skipped: DataFrame, today: str, days: int, most: int) -> DataFrame:
    """What is still to be transcribed: published, recorded, of the last ``days``, neither done nor skipped; the oldest ``most``."""
    open_ = events.where(F.col("published") & F.col("has_media") & F.to_date("date").between(F.date_sub(F.lit(today).cast("date"), days), F.lit(today).cast("date")))
    return open_.join(done.select("id"), "id", "left_anti").join(skipped.select("id"), "id", "left_anti").orderBy("date", "id").limit(most)


def hand_made(voices: Column) -> Column:
    """The entries of a map (letter to voice) that no machine made; a missing method means a person."""
    return F.map_filter(voices, lambda _, v: ~v["method"].eqNullSafe(F.lit("voiceprint")))


def enrich(rows: DataFrame, extra: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Rows with the fields of ``extra`` that are not empty in place of their own."""
    named = extra.select(*key, *(F.nullif(F.col(f), F.lit("")).alias(f"__{f}") for f in fields))
    joined = rows.join(named, key, "left")
    own = [F.col(f) if f in rows.columns else F.lit(None).cast("string") for f in fields]
    return joined.withColumns({f: F.coalesce(F.col(f"__{f}"), o) for f, o in zip(fields, own)}).drop(*(f"__{f}" for f in fields))


def stale(impact: Column, significance: Column, allowed: list[str]) -> Column:
    return F.coalesce(F.trim(impact), F.lit("")).eqNullSafe(F.lit("")) | ~F.coalesce(significance.isin(allowed), F.lit(False))


def until(df: DataFrame, key: str, order: str, stop: Column) -> DataFrame:
    """The rows of each key before the first that meets ``stop``."""
    first = df.groupBy(key).agg(F.min(F.when(stop, F.col(order))).alias("__stop"))
    return df.join(first, key).where(F.col("__stop").isNull() | (F.col(order) < F.col("__stop"))).drop("__stop")


def sharing(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that share the values of the columns with another row; counts are joined back, no window over a hot value."""
    several = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    return df.join(several, list(columns), "left_semi")


def tiered(df: DataFrame, key: str, tiers: list[Column], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each key by tier, then by the order; the tier is the first condition that holds."""
    tier = F.coalesce(*(F.when(t, n) for n, t in enumerate(tiers)), F.lit(len(tiers)))
    w = Window.partitionBy(key).orderBy("tier", *order)
    return df.withColumn("tier", tier).withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)


def upcoming(events: DataFrame, key: str, date: str, today: str) -> DataFrame:
    """The next event of each key from today on, and the days until then."""
    later = events.where(F.col(date) >= today)
    return later.groupBy(key).agg(F.min(date).alias("next")).withColumn("days_away", F.datediff(F.to_date("next"), F.lit(today).cast("date")))


def vocabulary(texts: DataFrame, text: str, names: list[str] = (), weight: int = 50) -> DataFrame:
    """(word, n): how often each word stands in the texts; each name counts as if it stood there ``weight`` times more."""
    words = texts.select(F.explode(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    if names:
        more = texts.sparkSession.createDataFrame([(w, weight) for n in names for w in n.lower().split()], "word string, n bigint")
        counts = counts.unionByName(more).groupBy("word").agg(F.sum("n").alias("n"))
    return counts


def in_order(df: DataFrame, key: str, order: list[Column], most: int | None = None) -> DataFrame:
    """``df`` with ``place``, the place of a row within its key; with ``most`` the first of each key only."""
    placed = df.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return placed if most is None else placed.where(F.col("place") <= most)


def latest(df: DataFrame, date: str, id_: str, most: int) -> DataFrame:
    """The ``most`` newest rows, of one day the larger id first, rows without a date last."""
    return df.orderBy(F.desc(F.coalesce(date, F.lit(""))), F.desc(id_)).limit(most)


def grouped(parents: DataFrame, children: DataFrame, foreign: str, order: list[str], fields: list[str]) -> DataFrame:
    """``parents`` with ``items``: their children (order, fields) in falling order; parents without any are left out."""
    items = children.groupBy(F.col(foreign).alias("id")).agg(F.sort_array(F.collect_list(F.struct(*order, *fields)), asc=False).alias("items"))
    return parents.join(items, "id")


def has_recording(event_media: Column, *paths: Column) -> Column:
    """Whether a meeting is said to have media and one of the paths to it is given."""
    return F.coalesce(event_media, F.lit(False)) & (F.coalesce(*(F.nullif(F.trim(p), F.lit("")) for p in paths)).isNotNull())


def public(bodies: DataFrame) -> DataFrame:
    return bodies.where(~F.coalesce("hidden", F.lit(False)))


def with_plain(rows: DataFrame, items: str, cache: DataFrame, key) -> DataFrame:
    """``rows`` with ``plain`` in each struct of the array ``items``: the text of the cache (key, plain) under the item's key.

    Items are looked up as rows and put together again by place, so the cache may have any size; rows need an ``id``."""
    placed = rows.select("id", F.posexplode(items).alias("pos", "i")).withColumn("key", key(F.col("i")))
    found = placed.join(cache.groupBy("key").agg(F.min("plain").alias("plain")), "key", "left")
    again = found.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "i", "plain"))), lambda x: x["i"].withField("plain", F.coalesce(x["plain"], F.lit("")))).alias("__i"))
    return rows.join(again, "id", "left").withColumn(items, F.coalesce("__i", F.array().cast(again.schema["__i"].dataType))).drop("__i")


def upcoming_card(events: DataFrame, today: str) -> DataFrame:
    """(body, id, date, start, items, hearings): of each body the next event by date and start, with its items that are no procedure and
    its public hearings.  events: (body, id, date, start, agenda array of (procedural, items array of (kind)))."""
    agenda = F.coalesce("agenda", F.array())
    items = F.aggregate(agenda, F.lit(0), lambda n, h: n + F.when(h["procedural"], 0).otherwise(F.size(h["items"])))
    hearings = F.aggregate(agenda, F.lit(0), lambda n, h: n + F.size(F.filter(h["items"], lambda i: F.upper(i["kind"]).contains("PUBLIC HEARING"))))
    later = events.where(F.col("date") >= today).select("body", "id", "date", F.coalesce("start", F.lit("")).alias("start"), items.alias("items"), hearings.alias("hearings"))
    return later.groupBy("body").agg(F.min(F.struct("date", "start", "id", "items", "hearings")).alias("x")).select("body", "x.*")


def linked(rows: DataFrame, pages: DataFrame, key: str, fallback: Column) -> DataFrame:
    """``rows`` with ``link``: the page of the key (pages: key, page), else the fallback."""
    one = pages.groupBy(key).agg(F.min("page").alias("__p"))
    return rows.join(one, key, "left").withColumn("link", F.coalesce("__p", fallback)).drop("__p")


def batched(df: DataFrame, key: str, order: list[str], most: int) -> DataFrame:
    """``df`` with ``batch``: consecutive rows of a key by ``most``, as they go into one call."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1) / most))


def to_do(rows: DataFrame, done: DataFrame, key: list[str], parameters: str) -> DataFrame:
    """Rows without a result made with these parameters; results (key, parameters) of others count as none."""
    return rows.join(done.where(F.col("parameters") == parameters).select(*key).distinct(), key, "left_anti")
