"""Roll calls: parsing, roll-ups, agreement and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.functions import text as T

KINDS = ("yes", "no", "abstain", "excused", "absent", "nay")


def roll_call(x: Column) -> Column:
    """"Name: Vote; ..." as an array of (name, vote); the last colon of a part divides it."""
    parts = F.filter(F.split(F.coalesce(x, F.lit("")), ";"), lambda s: s.contains(":"))
    return F.transform(parts, lambda s: F.struct(F.trim(F.regexp_extract(s, "^(.*):([^:]*)$", 1)).alias("name"), F.trim(F.regexp_extract(s, "^(.*):([^:]*)$", 2)).alias("vote")))


def roll_call_text(votes: Column) -> Column:
    """Votes (member_id, vote) as one sorted string."""
    return F.array_join(F.array_sort(F.transform(votes, lambda v: F.concat(F.coalesce(v["member_id"], F.lit("")), F.lit(": "), F.coalesce(v["vote"], F.lit(""))))), "; ")


def once(rows: DataFrame, *key: str, newest: str = "loaded_at") -> DataFrame:
    """Rows delivered again count once: of each key the one loaded last.

    By an aggregate, whose partial sums keep a hot key small, not by a window over it.
    """
    rest = [c for c in rows.columns if c not in key]
    picked = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(F.col(newest), F.xxhash64(*[c for c in rest if c != newest]))).alias("__r"))
    return picked.select(*key, "__r.*")


def cast_votes(motions: DataFrame) -> DataFrame:
    """(motion_id, pos, member_id, vote) for each vote of each motion."""
    return motions.select(F.col("id").alias("motion_id"), F.posexplode("votes").alias("pos", "v")).select("motion_id", "pos", "v.member_id", "v.vote")


def vote_counts(votes: DataFrame, members: DataFrame) -> DataFrame:
    """Counts of each kind of vote by member, members without votes kept, and the rate of yes among yes, no and nay.

    Votes are compared in lower case; other wordings count in the total only.
    """
    kind = F.lower("vote")
    counts = votes.groupBy("member_id").agg(F.count(F.lit(1)).alias("total"), *(F.count_if(kind == k).alias(k) for k in KINDS))
    filled = members.join(counts, "member_id", "left").na.fill(0, ["total", *KINDS])
    return filled.withColumn("yes_rate", F.round(F.coalesce(F.try_divide(F.col("yes"), F.col("yes") + F.col("no") + F.col("nay")), F.lit(0.0)), 6))


def agreement_class(x: Column) -> Column:
    """y for yes, n for no and nay, else x; two votes of class x agree."""
    low = F.lower(F.coalesce(x, F.lit("")))
    return F.when(low == "yes", "y").when(low.isin("no", "nay"), "n").otherwise("x")


def side(x: Column) -> Column:
    """y for yes and aye, n for no and nay, else x, which takes no side."""
    low = F.lower(F.coalesce(x, F.lit("")))
    return F.when(low.isin("yes", "aye"), "y").when(low.isin("no", "nay"), "n").otherwise("x")


def summary_class(x: Column) -> Column:
    """The widest reading: yes, aye, y; no, nay, n; else x."""
    low = F.lower(F.trim(F.coalesce(x, F.lit(""))))
    return F.when(low.isin("yes", "aye", "y"), "y").when(low.isin("no", "nay", "n"), "n").otherwise("x")


def pair_agreement(votes: DataFrame) -> DataFrame:
    """(a, b, agreement, n) for each unordered pair of members who voted in one roll call.

    Pairs are counted by position, so a member named twice in a roll call makes a pair with itself.  The pairs of a
    roll call are those of its few members; counts are summed before they are shuffled.
    """
    calls = votes.groupBy("motion_id").agg(F.array_sort(F.collect_list(F.struct("pos", "member_id", agreement_class(F.col("vote")).alias("k")))).alias("v"))
    pairs = F.flatten(
        F.transform("v", lambda x, i: F.transform(F.slice(F.col("v"), i + 2, F.size("v")), lambda y: F.struct(F.least(x["member_id"], y["member_id"]).alias("a"), F.greatest(x["member_id"], y["member_id"]).alias("b"), (x["k"] == y["k"]).cast("int").alias("same"))))
    )
    return calls.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.round(F.avg("p.same"), 6).alias("agreement"), F.count(F.lit(1)).alias("n"))


def divided(votes: DataFrame) -> DataFrame:
    """(motion_id, yes, no, minority) of roll calls with votes on both sides; a tie has no minority."""
    k = side(F.col("vote"))
    sums = votes.groupBy("motion_id").agg(F.count_if(k == "y").alias("yes"), F.count_if(k == "n").alias("no")).where("yes > 0 AND no > 0")
    return sums.withColumn("minority", F.when(F.col("yes") < F.col("no"), "y").when(F.col("no") < F.col("yes"), "n"))


def split_record(votes: DataFrame) -> DataFrame:
    """(member_id, seen, lost): divided roll calls a member voted in, and on the smaller side of."""
    k = side(F.col("vote"))
    joined = votes.join(divided(votes).select("motion_id", "minority"), "motion_id").where(k != "x")
    return joined.groupBy("member_id").agg(F.count(F.lit(1)).alias("seen"), F.count_if(k == F.col("minority")).alias("lost"))


def resolve_aliases(names: DataFrame, aliases: DataFrame, ignored: DataFrame) -> DataFrame:
    """names (name) with the member whose normalised alias it equals; ``state`` is resolved, ignored or unresolved.

    Of one alias given to several members the smallest id holds.  Spark picks the join by the size of the aliases.
    """
    one = aliases.select(T.norm_name(F.col("alias")).alias("__n"), "member_id").where("__n <> ''").groupBy("__n").agg(F.min("member_id").alias("member_id"))
    skip = ignored.select(T.norm_name(F.col("name")).alias("__n"), F.lit(True).alias("__skip")).distinct()
    joined = names.withColumn("__n", T.norm_name(F.col("name"))).join(one, "__n", "left").join(skip, "__n", "left")
    state = F.when(F.col("member_id").isNotNull(), "resolved").when(F.col("__skip"), "ignored").otherwise("unresolved")
    return joined.withColumn("state", state).drop("__n", "__skip")


def tag_texts(texts: DataFrame, rules: list[tuple[str, str]], key: str, text: str) -> DataFrame:
    """(key, tags): the tags, in the order of the rules, of which a keyword stands in the text as a whole word.

    rules are (tag, keyword); one pattern for each tag, no join.
    """
    by_tag: dict[str, list[str]] = {}
    for tag, keyword in rules:
        by_tag.setdefault(tag, []).append(keyword)
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    hits = [F.when(low.rlike(T.whole_word("(" + "|".join(words) + ")")), F.lit(tag)) for tag, words in by_tag.items()]
    return texts.select(key, F.filter(F.array(*hits), lambda t: t.isNotNull()).alias("tags"))
