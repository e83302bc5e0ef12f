"""Retrieval: a written index of postings, BM25 with boosts, the claim search, greedy selection and novelty.

The corpus is read once, when its index is written.  Postings are sorted by term over files of equal size, so a question reads
the few pages of its terms, and hold all that a score needs, so it joins nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from quorumlake.functions import text as T

# Constants of the ranking.
K1, B, TITLE_BOOST, TAG_BOOST = 1.2, 0.75, 1.3, 1.15
KIND_WEIGHT = {"tax": 1.25, "budget": 1.25, "meeting": 1.1, "motion": 1.0, "transcript": 0.55}
PINNED = ("overview", "member", "upcoming")


def idf(n: Column, df: Column) -> Column:
    return F.greatest(F.lit(0.3), F.log(1 + (n - df + 0.5) / (df + 0.5)))


def _text(title: str = "title", text: str = "text") -> Column:
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(text, F.lit("")))


def postings(docs: DataFrame, places: tuple[str, ...] = ()) -> DataFrame:
    """(term, doc_id, tf, dl, in_title, in_tags, kind, body, date): one row for each stem that a document holds.

    docs: (doc_id, title, text, tags, kind, body, date), doc_id unique.  tf counts title and text, dl all their index words;
    a stem of tags only has a tf of 0.  in_title looks at the first 200 characters of the title.  Words are counted first,
    and stems taken of a document's different words.
    """
    place = lambda n, x: F.transform(T.index_words(x, places), lambda w: F.struct(F.lit(n).alias("at"), w.alias("w")))
    own = T.index_words(_text(), places)
    rest = F.concat(place(1, F.left(F.coalesce("title", F.lit("")), F.lit(200))), place(2, F.array_join(F.coalesce("tags", F.array().cast("array<string>")), " ")))
    meta = ("doc_id", "dl", "kind", "body", "date")
    rows = docs.select("doc_id", "kind", "body", "date", own.alias("__own"), rest.alias("__rest")).withColumn("dl", F.size("__own"))
    rows = rows.select(*meta, F.explode(F.concat(F.transform("__own", lambda w: F.struct(F.lit(0).alias("at"), w.alias("w"))), "__rest")).alias("x"))
    flags = rows.select(*meta, F.col("x.w").alias("w"), *((F.col("x.at") == n).cast("int").alias(c) for n, c in enumerate(("tf", "in_title", "in_tags"))))
    # what goes with a document is a key of the sums, so they are hashed and not sorted
    sums = (F.sum("tf").cast("int").alias("tf"), F.max("in_title").alias("in_title"), F.max("in_tags").alias("in_tags"))
    words = flags.groupBy(*meta, "w").agg(*sums)
    stems = words.withColumn("term", T.stem(F.col("w"))).groupBy(*meta, "term").agg(*sums)
    return stems.withColumns({c: F.col(c) > 0 for c in ("in_title", "in_tags")})


def claim_postings(docs: DataFrame) -> DataFrame:
    """(term, doc_id, len, kind): one row for each word of the claim search that a document holds; len is the number of them."""
    sets = docs.select("doc_id", "kind", T.claim_word_set(_text()).alias("s"))
    return sets.select("doc_id", "kind", F.size("s").alias("len"), F.explode("s").alias("term"))


def write_index(docs: DataFrame, path: str, places: tuple[str, ...] = (), parts: int | None = None) -> Index:
    """Writes the index of a corpus to a shared folder and opens it.

    The documents are dealt out to parts once; a part holds all postings of its documents, sorted by term.  So no term is
    hot, counting and stemming need no further shuffle, and a question reads the pages of its terms in every part.
    """
    n = parts or max(2 * docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    needed = docs.select("doc_id", "title", "text", "tags", "kind", "body", "date")
    for name, rows in (("postings", postings(needed.repartition(n, "doc_id"), places)), ("words", claim_postings(needed))):
        rows.sortWithinPartitions("term", "doc_id").write.mode("overwrite").option("parquet.block.size", 8 << 20).option("parquet.page.row.count.limit", 4_000).parquet(f"{path}/{name}")
    index = Index(docs.sparkSession, path)
    index.postings.where("tf > 0").groupBy("term").agg(F.count(F.lit(1)).alias("df")).write.mode("overwrite").parquet(f"{path}/terms")
    # documents without a word count in the means, so sums are taken over postings and divided by all documents
    number = docs.agg(F.count("doc_id").alias("n"))
    lengths = index.postings.agg(F.sum("tf").alias("tokens")).crossJoin(index.words.agg(F.count(F.lit(1)).alias("set_words")))  # one row each
    number.crossJoin(lengths).write.mode("overwrite").parquet(f"{path}/stats")
    return index


@dataclass
class Index:
    """A written index: tables postings, words, terms (term, df) and one row of statistics."""

    spark: SparkSession
    path: str

    @cached_property
    def stats(self) -> Row:
        return self.spark.read.parquet(f"{self.path}/stats").first()

    @cached_property
    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/postings")

    @cached_property
    def words(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/words")

    @cached_property
    def terms(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/terms")


def query_terms(question: str, prior: list[str], aliases: dict[str, list[str]], spark: SparkSession) -> list[tuple[str, float, bool]]:
    """(term, weight, required): the current question's terms with their aliases weigh 1, those of prior ones 0.35.

    All of it folds into constants, so no job is run.
    """
    known = sorted(aliases)
    turns = F.array(*(T.tokens(F.lit(q)) for q in (question, *prior)))
    others = F.array(*(F.array(*(T.stem(F.lit(w)) for w in aliases[k])) for k in known)) if known else F.array().cast("array<array<string>>")
    row = spark.range(1).select(turns.alias("turns"), others.alias("others")).first()
    more, weights = dict(zip(known, row["others"])), {}
    for n, words in enumerate(row["turns"]):
        for w in [x for word in words for x in (word, *more.get(word, ()))]:
            weights.setdefault(w, 1.0 if n == 0 else 0.35)
    return [(w, x, x == 1.0) for w, x in weights.items()]


def bm25(index: Index, terms: list[tuple[str, float, bool]], body: str | None = None, now: str | None = None, recency_weight: float = 0.3, recency_days: float = 1800.0) -> DataFrame:
    """(doc_id, score) of documents that hold a required term, by BM25 with boosts for title, tags, kind and date.

    Reads the postings of the question's terms only; statistics are over all documents of the index.
    """
    names = [term for term, _, _ in terms]
    held = index.postings.where(F.col("term").isin(names) & ~F.coalesce("kind", F.lit("")).isin(*PINNED))
    if body:
        held = held.where(F.coalesce("body", F.lit("")).isin(body, ""))
    df = {r["term"]: r["df"] for r in index.terms.where(F.col("term").isin(names)).collect()}  # the words of a question
    n, average = float(index.stats["n"]), (index.stats["tokens"] or 0) / max(index.stats["n"], 1)
    weight = F.coalesce(*(F.when(F.col("term") == t, idf(F.lit(n), F.lit(float(df.get(t, 0)))) * w) for t, w, _ in terms), F.lit(None))
    tf = F.col("tf").cast("double")
    part = F.when(tf > 0, weight * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("dl") / F.lit(average)))).otherwise(0.0)
    required = [t for t, _, needed in terms if needed]
    meta = (F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("date", F.lit("")).alias("date"))  # keys, as they go with the document
    scored = held.select("doc_id", *meta, part.alias("part"), "in_title", "in_tags", (F.col("term").isin(required or names) & (F.col("tf") > 0)).alias("asked")).groupBy("doc_id", "kind", "date").agg(
        F.sum("part").alias("score"), F.bool_or("in_title").alias("in_title"), F.bool_or("in_tags").alias("in_tags"), F.bool_or("asked").alias("asked")
    )
    kind = F.coalesce(*(F.when(F.col("kind") == k, w) for k, w in KIND_WEIGHT.items()), F.lit(1.0))
    score = F.col("score") * F.when(F.col("in_title"), TITLE_BOOST).otherwise(1.0) * F.when(F.col("in_tags"), TAG_BOOST).otherwise(1.0) * kind
    if now:
        age = F.datediff(F.to_date(F.lit(now)), F.try_to_timestamp("date", F.lit("yyyy-MM-dd")).cast("date"))
        score = score * F.when(age.isNull(), 1.0).otherwise(1.0 + recency_weight * F.exp(-F.greatest(age, F.lit(0)) / recency_days))
    return scored.where("asked").select("doc_id", score.alias("score")).where("score > 0")


def claim_search(index: Index, docs: DataFrame, claim: str, most: int = 8) -> DataFrame:
    """(doc_id, score): documents that hold every quoted phrase of the claim, by the weight of the set of words they share with it.

    Words are looked up in the index; texts are read only where the claim quotes something.  A document of kind claim counts a
    quarter more.
    """
    phrases = [p.lower() for p in re.findall(r'"([^"]+)"', claim)]
    words = [r["w"] for r in index.spark.range(1).select(F.explode(F.array_distinct(T.claim_tokens(F.lit(claim.replace('"', " "))))).alias("w")).collect()]
    held = index.words.where(F.col("term").isin(words))
    df = {r["term"]: r["df"] for r in held.groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}  # the words of a claim
    n, average = float(index.stats["n"]), index.stats["set_words"] / max(index.stats["n"], 1)
    weight = F.coalesce(*(F.when(F.col("term") == w, F.log(1 + F.lit(n) / (1.0 + df[w]))) for w in words if w in df), F.lit(0.0))
    score = F.sum(weight) * F.any_value(F.lit(average) / (F.lit(average) + F.col("len"))) * F.any_value(F.when(F.col("kind") == "claim", 1.25).otherwise(1.0))
    found = held.groupBy("doc_id").agg(F.round(score, 6).alias("score"))
    if phrases:
        low = F.lower(_text())
        quoting = docs.where(_all(F.contains(low, F.lit(p)) for p in phrases)).select("doc_id")
        found = found.join(quoting, "doc_id", "left_semi")
    return found.where("score > 0").orderBy(F.desc("score"), "doc_id").limit(most)


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def select_passages(ranked: DataFrame, k: int = 8, budget: int = 16_000, transcripts: int = 2, per_url: int = 2) -> list[dict]:
    """The greedy walk over passages (score, doc_id, kind, url, chars): up to k, within the budget of characters, at most so
    many transcripts and so many of one address (none counts as one); a passage passed over uses nothing.

    The result is the few passages of one prompt, so it is a list.  Only rows that the walk can reach come to the
    driver, and the walk over them is exact: of each address and class the first ``per_url`` can be taken; as at most k
    are taken, no more than k of a class are passed over for their address, so the first 2k of one class and the first
    ``transcripts`` + k of the other are enough.
    """
    heard_kind = F.coalesce(F.col("kind") == "transcript", F.lit(False))
    order = [F.desc("score"), F.col("doc_id")]
    near = ranked.withColumn("__t", heard_kind).withColumn("__r", F.row_number().over(Window.partitionBy(F.coalesce("url", F.lit("")), "__t").orderBy(*order))).where(F.col("__r") <= per_url)
    top = near.where(~F.col("__t")).orderBy(*order).limit(2 * k).unionByName(near.where("__t").orderBy(*order).limit(transcripts + k))
    chosen, chars, heard, seen = [], 0, 0, {}
    for r in sorted(top.drop("__t", "__r").collect(), key=lambda r: (-r["score"], r["doc_id"])):
        if len(chosen) >= k or chars >= budget:
            break
        if r["kind"] == "transcript" and heard >= transcripts or seen.get(r["url"], 0) >= per_url:
            continue
        chosen.append(r.asDict())
        chars += r["chars"]
        heard += r["kind"] == "transcript"
        seen[r["url"]] = seen.get(r["url"], 0) + 1
    return chosen


def novel(passages: DataFrame, key: str, order: str, text: str, threshold: float = 0.55) -> DataFrame:
    """Passages, in order, of which less than ``threshold`` of every earlier kept one's words are held; each kept one becomes known.

    The fold is sequential within a key.  Known sets are found through a word index, so a passage is compared
    with those that share a word with it and not with all.
    """
    kind = passages.schema[key].dataType.simpleString()
    order_kind = passages.schema[order].dataType.simpleString()

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order, kind="stable")
        known: list[set[str]] = []
        index: dict[str, list[int]] = {}
        kept = []
        for row in group.itertuples(index=False):
            words = set(re.findall("[a-z]{4,}", (getattr(row, text) or "").lower()))
            shared: dict[int, int] = {}
            for w in words:
                for i in index.get(w, ()):
                    shared[i] = shared.get(i, 0) + 1
            if any(n / len(known[i]) >= threshold for i, n in shared.items()):
                continue
            kept.append((getattr(row, key), getattr(row, order), getattr(row, text)))
            for w in words:
                index.setdefault(w, []).append(len(known))
            known.append(words)
        return pd.DataFrame(kept, columns=[key, order, text])

    return passages.select(key, order, text).groupBy(key).applyInPandas(fold, f"{key} {kind}, {order} {order_kind}, {text} string")


def merge_history(turns: DataFrame, key: str, order: str, role: str, text: str, last: int = 6) -> DataFrame:
    """The last turns of each conversation, from the first of the user on, one for each run of a role (its last), no user turn at the end."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    recent = turns.where(F.length(F.trim(text)) > 0).withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= last)
    up = Window.partitionBy(key).orderBy(order)
    every = Window.partitionBy(key)
    lead_in = recent.withColumn("__first", F.min(F.when(F.col(role) == "user", F.col(order))).over(every)).where(F.col(order) >= F.col("__first"))
    runs = lead_in.withColumn("__n", F.lead(role).over(up)).where(F.col("__n").isNull() | (F.col("__n") != F.col(role)))
    ended = runs.withColumn("__last", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where(~((F.col("__last") == 1) & (F.col(role) == "user")))
    return ended.select(key, order, role, F.trim(text).alias(text))
