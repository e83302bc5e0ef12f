"""Queries over the retrieval corpus and over voices."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.functions import text as T
from quorumlake.io import shared_folder, state_of, table
from quorumlake.operators import search as S
from quorumlake.operators import voices as V
from quorumlake.plans.registry import query

_STOP = "[" + ",".join(f"'{w}'" for w in T.STOP_WORDS) + "]"
_NOISE = "[" + ",".join(f"'{w}'" for w in T.NOISE_WORDS) + "]"
# the stemmer step by step, each on the result of the one before
_PLURAL = "CASE WHEN ends_with({w},'ies') AND length({w})>4 THEN left({w},length({w})-3)||'y' WHEN regexp_matches({w},'(ch|sh|ss|x|z)es$') THEN left({w},length({w})-2) WHEN ends_with({w},'s') AND NOT ends_with({w},'ss') AND NOT ends_with({w},'us') THEN left({w},length({w})-1) ELSE {w} END"
_ENDING = "CASE WHEN ends_with({w},'ing') AND length({w})>5 THEN left({w},length({w})-3) WHEN ends_with({w},'ed') AND length({w})>4 THEN left({w},length({w})-2) ELSE {w} END"
_LAST = "CASE WHEN length({w})>3 AND ends_with({w},'e') THEN left({w},length({w})-1) ELSE {w} END"


def tokens_sql(source: str, key: str, text: str) -> str:
    """(key, term) rows of the index tokens of a text expression, as a subquery."""
    words = f"(SELECT {key}, unnest(regexp_extract_all(lower(coalesce({text},'')), '[a-z0-9]+')) AS w FROM {source})"
    kept = f"(SELECT {key}, w AS w0, w FROM {words} WHERE length(w)>1 AND NOT list_contains({_STOP}, w))"
    one = f"(SELECT {key}, w0, {_PLURAL.format(w='w')} AS w FROM {kept})"
    two = f"(SELECT {key}, w0, {_ENDING.format(w='w')} AS w FROM {one})"
    return f"(SELECT {key}, CASE WHEN length(w0)<=3 THEN w0 ELSE {_LAST.format(w='w')} END AS term FROM {two})"


_DOC_TOKENS = tokens_sql("documents", "doc_id", "concat_ws(' ', coalesce(title,''), coalesce(text,''))")


_indexes: dict[tuple[str, str], tuple[str, S.Index]] = {}


def index_of(spark: SparkSession, folder: str) -> S.Index:
    """The written index of the corpus, made at the first question and again when the files of the corpus have changed."""
    key, state = (spark.sparkContext.applicationId, folder), state_of(spark, f"{folder}/documents.parquet")
    if key not in _indexes or _indexes[key][0] != state:
        _indexes[key] = state, S.write_index(table(spark, folder, "documents"), shared_folder(spark, f"index/{uuid.uuid4()}"))
    return _indexes[key][1]


@query(f"WITH t AS {_DOC_TOKENS} SELECT (SELECT count(*) FROM documents) AS n, count(*)::BIGINT AS tokens, count(DISTINCT term) AS terms FROM t")
def retrieval_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index of the corpus, written at the first use, and its sizes."""
    index = index_of(spark, folder)
    return index.terms.agg(F.lit(index.stats["n"]).alias("n"), F.lit(index.stats["tokens"]).alias("tokens"), F.count(F.lit(1)).alias("terms"))


@query(f"WITH t AS {_DOC_TOKENS} SELECT term, count(DISTINCT doc_id) AS df, round(greatest(0.3, ln(1+((SELECT count(*) FROM documents)-count(DISTINCT doc_id)+0.5)/(count(DISTINCT doc_id)+0.5))),6) AS idf FROM t GROUP BY 1")
def doc_freq(spark: SparkSession, folder: str) -> DataFrame:
    index = index_of(spark, folder)
    return index.terms.select("term", "df", F.round(S.idf(F.lit(float(index.stats["n"])), F.col("df")), 6).alias("idf"))


_QUESTION = "Which planning decisions approved the water budget and the sewer assessment?"
_PRIOR = ["What did the council say about the pavilion?"]
_ALIASES = {"decision": ["ruling"], "sewer": ["wastewater"], "plan": ["zoning"]}
_ALIAS_SQL = ",".join(f"('{a}','{b}')" for a, bs in _ALIASES.items() for b in bs)


@query(f"""WITH t AS MATERIALIZED {_DOC_TOKENS},
q0 AS (SELECT turn, term FROM {tokens_sql("(VALUES (0,'" + _QUESTION + "'),(1,'" + _PRIOR[0] + "')) x(turn,q)", 'turn', 'q')}),
al AS (SELECT q0.turn, b FROM q0 JOIN (VALUES {_ALIAS_SQL}) a(a,b) ON q0.term=a.a),
q AS (SELECT term, CASE WHEN min(turn)=0 THEN 1.0 ELSE 0.35 END::DOUBLE AS w, min(turn)=0 AS req FROM (SELECT turn, term FROM q0 UNION ALL SELECT turn, term FROM {tokens_sql('al','turn','b')}) GROUP BY 1),
dl AS (SELECT d.doc_id, count(t.term) AS dl FROM documents d LEFT JOIN t USING(doc_id) GROUP BY 1), st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
tf AS (SELECT doc_id, term, count(*)::DOUBLE AS f FROM t JOIN q USING(term) GROUP BY 1,2), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
s AS (SELECT doc_id, sum(greatest(0.3, ln(1+(n-df+0.5)/(df+0.5)))*w*f*2.2/(f+1.2*(0.25+0.75*dl/avgdl))) AS s, bool_or(req) AS req FROM tf JOIN q USING(term) JOIN df USING(term) JOIN dl USING(doc_id), st GROUP BY 1),
ti AS (SELECT DISTINCT doc_id FROM {tokens_sql('documents','doc_id',"left(coalesce(title,''),200)")} JOIN q USING(term)),
tg AS (SELECT DISTINCT doc_id FROM {tokens_sql('(SELECT doc_id, unnest(tags) AS g FROM documents)','doc_id','g')} JOIN q USING(term))
SELECT s.doc_id, round(s.s*CASE WHEN ti.doc_id IS NOT NULL THEN 1.3 ELSE 1 END*CASE WHEN tg.doc_id IS NOT NULL THEN 1.15 ELSE 1 END*CASE d.kind WHEN 'tax' THEN 1.25 WHEN 'budget' THEN 1.25 WHEN 'meeting' THEN 1.1 WHEN 'transcript' THEN 0.55 ELSE 1 END
 *CASE WHEN try_strptime(d.date,'%Y-%m-%d') IS NULL THEN 1 ELSE 1+0.3*exp(-greatest(date_diff('day', try_strptime(d.date,'%Y-%m-%d'), TIMESTAMP '2026-06-01'),0)/1800.0) END, 6) AS score
FROM s JOIN documents d USING(doc_id) LEFT JOIN ti USING(doc_id) LEFT JOIN tg USING(doc_id) WHERE s.req AND coalesce(d.kind,'') NOT IN ('overview','member','upcoming')""")
def bm25(spark: SparkSession, folder: str) -> DataFrame:
    terms = S.query_terms(_QUESTION, _PRIOR, _ALIASES, spark)
    return S.bm25(index_of(spark, folder), terms, now="2026-06-01").select("doc_id", F.round("score", 6).alias("score"))


_CLAIM = 'The board told drivers that the "temporary" culvert near the road would cost 41 percent more'


@query(f"""WITH t AS MATERIALIZED (SELECT DISTINCT doc_id, w FROM (SELECT doc_id, unnest(regexp_extract_all(lower(concat_ws(' ', coalesce(title,''), coalesce(text,''))), '[a-z0-9][a-z0-9''%.$-]*')) AS w FROM documents) WHERE length(w)>1 AND NOT list_contains({_NOISE}, w)),
q AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(lower('{_CLAIM.replace('"', ' ')}'), '[a-z0-9][a-z0-9''%.$-]*')) AS w) WHERE length(w)>1 AND NOT list_contains({_NOISE}, w)),
l AS (SELECT d.doc_id, count(t.w) AS len FROM documents d LEFT JOIN t USING(doc_id) GROUP BY 1), st AS (SELECT count(*) AS n, avg(len) AS a FROM l), h AS (SELECT doc_id, w FROM t JOIN q USING(w)), df AS (SELECT w, count(*) AS df FROM h GROUP BY 1)
SELECT doc_id, score FROM (SELECT h.doc_id, round(sum(ln(1+n/(1+df)::DOUBLE))*any_value(a/(a+len))*any_value(CASE WHEN kind='claim' THEN 1.25 ELSE 1 END),6) AS score FROM h JOIN df USING(w) JOIN l USING(doc_id) JOIN documents d USING(doc_id), st WHERE contains(lower(concat_ws(' ', coalesce(d.title,''), coalesce(d.text,''))), 'temporary') GROUP BY 1) ORDER BY score DESC, doc_id LIMIT 8""")
def claim_search(spark: SparkSession, folder: str) -> DataFrame:
    return S.claim_search(index_of(spark, folder), table(spark, folder, "documents"), _CLAIM)


def greedy_passages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    ranked = bm25(spark, folder).join(docs.select("doc_id", "kind", "url", (F.least(F.length("text"), F.lit(1_400)) + F.least(F.length(F.coalesce("title", F.lit(""))), F.lit(160))).alias("chars")), "doc_id")
    rows = [(n, r["doc_id"], r["score"]) for n, r in enumerate(S.select_passages(ranked))]
    return spark.createDataFrame(rows, "rank int, doc_id bigint, score double")


query()(greedy_passages)


@query()
def novel_claims(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").where("kind = 'claim'").select(F.coalesce("body", F.lit("")).alias("body"), "doc_id", "text")
    return S.novel(docs, "body", "doc_id", "text").select("body", "doc_id")


_SCORE = " + ".join(f"CASE WHEN regexp_matches(CASE WHEN strong THEN low ELSE close END, '{p.replace(chr(39), chr(39) * 2)}') THEN {w} ELSE 0 END" for p, w in T.CHECKABLE)
# the marks of the claim search, and wordings of second-hand reports that these records have
_STRONG, _WEAK = f"{T.STRONG_MARKS}|told the board|said the", f"{T.WEAK_MARKS}|questioned the"
_S, _W, _N = (p.replace("'", "''") for p in (_STRONG, _WEAK, T.NO_CLAIM))


@query(f"""WITH s AS (SELECT doc_id, list_filter(string_split(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x<>'') AS s FROM documents),
f AS (SELECT doc_id, s, unnest(range(0,len(s))) AS n FROM s),
w AS (SELECT doc_id, n AS sentence_no, lower(array_to_string(s[greatest(n,1):n+3],' ')) AS low, lower(array_to_string(s[n+1:n+2],' ')) AS close FROM f WHERE regexp_matches(lower(s[n+1]), '{_S}|{_W}')),
k AS (SELECT *, regexp_matches(low,'{_S}') AS strong FROM w)
SELECT doc_id, sentence_no, round(CASE WHEN regexp_matches(low,'{_N}') THEN 0 ELSE CASE WHEN strong THEN 3.0 ELSE 1.6 END + {_SCORE} - CASE WHEN regexp_matches(right(low,60),'{_S}|{_W}') AND NOT regexp_matches(left(low,greatest(length(low)-60,0)),'{_S}|{_W}') THEN 1.5 ELSE 0 END - CASE WHEN len(string_split(trim(low),' '))<14 THEN 1.2 ELSE 0 END END::DOUBLE, 6) AS score FROM k""")
def mined_claims(spark: SparkSession, folder: str) -> DataFrame:
    from quorumlake.operators.sequences import sentence_windows

    w = sentence_windows(table(spark, folder, "documents"), "doc_id", "text", f"{_STRONG}|{_WEAK}")
    return w.select("doc_id", "sentence_no", F.round(T.claim_score(F.col("passage"), F.col("near"), _STRONG, _WEAK), 6).alias("score"))


@query("""SELECT label, i::INT AS i, round(avg(x),6) AS m FROM (SELECT label, unnest(range(0,len(embedding))) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY 1,2""")
def centroid(spark: SparkSession, folder: str) -> DataFrame:
    c = V.centroids(table(spark, folder, "embeddings"), "label", "embedding")
    return c.select("label", F.posexplode("centroid").alias("i", "m")).withColumn("m", F.round("m", 6))


_EACH = "e AS (SELECT vec_id, label, vec_id%8 AS night, unnest(range(0,len(embedding))) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings)"


def _judged_sql(pairs: str) -> str:
    """Decisions over all vectors; ``pairs`` says with which voices a vector is compared."""
    return f"""WITH {_EACH}, c AS (SELECT label AS lib, i, sum(x) AS s, count(*) AS n FROM e GROUP BY 1,2), len AS (SELECT vec_id, sqrt(sum(x*x)) AS l FROM e GROUP BY 1),
p AS (SELECT e.vec_id, e.label, lib, x, CASE WHEN lib=e.label AND n>1 THEN (s-x)/(n-1) ELSE s/n END AS y FROM e JOIN c USING(i) WHERE {pairs}),
sc AS (SELECT vec_id, any_value(label) AS own, lib AS label, sum(x*y)/greatest(sqrt(sum(x*x)),1e-9)/greatest(sqrt(sum(y*y)),1e-9) AS score FROM p GROUP BY vec_id, lib), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) AS rank FROM sc),
nm AS (SELECT label, night, i, avg(x) AS v FROM e GROUP BY 1,2,3), nl AS (SELECT label, night, sqrt(sum(v*v)) AS l FROM nm GROUP BY 1,2),
w AS (SELECT vec_id, own, label AS best FROM r WHERE rank=1),
hn AS (SELECT w.vec_id, nm.night, sum(e.x*nm.v)/greatest(any_value(len.l),1e-9)/greatest(any_value(nl.l),1e-9) AS s FROM w JOIN e USING(vec_id) JOIN len USING(vec_id) JOIN nm ON nm.label=w.best AND nm.i=e.i JOIN nl ON nl.label=nm.label AND nl.night=nm.night WHERE NOT (w.own=w.best AND nm.night=e.night) GROUP BY 1,2),
hc AS (SELECT vec_id, count(*)::INT AS nights, count(*) FILTER (s>={V.NIGHT_FLOOR})::INT AS hits FROM hn GROUP BY 1),
d AS (SELECT vec_id, any_value(own) AS own, max(CASE WHEN rank=1 THEN label END) AS best, max(score) AS score, max(CASE WHEN rank=2 THEN label END) AS runner_up, max(score)-coalesce(max(CASE WHEN rank=2 THEN score END),0) AS margin,
 CASE WHEN count(*)-1>=3 THEN (max(score)-avg(CASE WHEN rank>1 THEN score END))/greatest(stddev_pop(CASE WHEN rank>1 THEN score END),1e-6) END AS z FROM r GROUP BY 1),
v AS (SELECT d.*, coalesce(nights,0) AS nights, coalesce(hits,0) AS hits, CASE WHEN score<{V.FLOOR} THEN 'below the floor' WHEN margin<{V.MARGIN} THEN 'too close to the next' WHEN z<{V.Z_LEAST} THEN 'not apart from the rest' WHEN coalesce(nights,0)<2 THEN 'known from one night' WHEN coalesce(hits,0)<least(2,coalesce(nights,0)) THEN 'heard on too few nights' ELSE 'named' END AS verdict FROM d LEFT JOIN hc USING(vec_id))"""


_RANKED = _judged_sql("true")


def _decided(spark: SparkSession, folder: str, strangers: bool = False) -> DataFrame:
    e = table(spark, folder, "embeddings").withColumn("night", F.col("vec_id") % 8)  # the nights of the voices
    nights = V.night_centroids(e, "label", "night", "embedding")
    return V.judged(e, V.centroids(e, "label", "embedding"), nights, "vec_id", "label", "night", "embedding", own="label", own_night="night", strangers=strangers)


@query(_RANKED + " SELECT vec_id, best, round(score,6) AS score, runner_up, round(margin,6) AS margin, round(z,5) AS z, nights, hits, verdict FROM v")
def best_runner_up(spark: SparkSession, folder: str) -> DataFrame:
    return _decided(spark, folder).select("vec_id", "best", F.round("score", 6).alias("score"), "runner_up", F.round("margin", 6).alias("margin"), F.round("z", 5).alias("z"), "nights", "hits", "verdict")


_FLOORS, _MARGINS = [0.3, 0.4, 0.5, 0.6, 0.7, 0.8], [0.0, 0.04, 0.08, 0.12]


def _trials(spark: SparkSession, folder: str) -> DataFrame:
    return _decided(spark, folder).join(table(spark, folder, "embeddings").select("vec_id", F.col("label").alias("own")), "vec_id")


@query(_RANKED + f""" SELECT f AS floor, m AS margin, count(*) FILTER (v.score>=f AND v.margin>=m) AS named, count(*) FILTER (v.score>=f AND v.margin>=m AND best=own) AS "right" FROM v, (SELECT unnest({_FLOORS})::DOUBLE AS f) a, (SELECT unnest({_MARGINS})::DOUBLE AS m) b GROUP BY 1,2""")
def threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return V.sweep(_trials(spark, folder), "score", "margin", F.col("best") == F.col("own"), _FLOORS, _MARGINS)


@query(_RANKED + """, k AS (SELECT v.*, (SELECT count(DISTINCT vec_id%8) FROM embeddings b WHERE b.label=v.own)>1 AS elsewhere FROM v) SELECT count(*) AS trials, count(*) FILTER (best=own) AS nearest_right, count(*) FILTER (verdict='named') AS named, count(*) FILTER (verdict='named' AND best=own) AS "right", count(*) FILTER (verdict='named' AND best<>own) AS wrong,
 count(*) FILTER (verdict<>'named') AS silent, count(*) FILTER (elsewhere) AS findable, count(*) FILTER (elsewhere AND verdict='named' AND best=own) AS found, count(*) FILTER (NOT elsewhere AND verdict<>'named') AS declined FROM k""")
def hold_one_out(spark: SparkSession, folder: str) -> DataFrame:
    nights = table(spark, folder, "embeddings").groupBy(F.col("label").alias("own")).agg((F.count_distinct(F.col("vec_id") % 8) > 1).alias("elsewhere"))
    return V.trial_metrics(_trials(spark, folder).join(nights, "own"), "own", F.col("elsewhere"))


@query(_judged_sql("lib<>e.label") + " SELECT verdict, count(*) AS strangers FROM v GROUP BY 1")
def open_set(spark: SparkSession, folder: str) -> DataFrame:
    return _decided(spark, folder, strangers=True).groupBy("verdict").agg(F.count(F.lit(1)).alias("strangers"))


_NIGHTS = """WITH e AS (SELECT label, vec_id%8 AS night, unnest(range(0,len(embedding))) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT label, night, i, avg(x) AS x FROM e GROUP BY 1,2,3), u AS (SELECT *, x/greatest(sqrt(sum(x*x) OVER (PARTITION BY label,night)),1e-9) AS v FROM m),
p AS (SELECT a.label, a.night, b.night, sum(a.v*b.v) AS s FROM u a JOIN u b ON a.label=b.label AND a.i=b.i AND a.night<b.night GROUP BY 1,2,3)"""


@query(_NIGHTS + " SELECT label, round(avg(s),6) AS mean, round(quantile_cont(s,0.05),6) AS p05, round(quantile_cont(s,0.95),6) AS p95, round(min(s),6) AS least, round(max(s),6) AS most, count(*) AS n FROM p GROUP BY 1")
def night_pairs(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "embeddings").withColumn("night", F.col("vec_id") % 8)  # the nights of the voices
    pairs = V.night_pairs(V.night_centroids(e, "label", "night", "embedding"), "label", "night")
    return pairs.select("label", *(F.round(c, 6).alias(c) for c in ("mean", "p05", "p95", "least", "most")), "n")


@query(f"""WITH {_EACH}, u AS (SELECT *, x/greatest(sqrt(sum(x*x) OVER (PARTITION BY vec_id)),1e-9) AS v FROM e), m AS (SELECT label, night, i, avg(v) AS m, count(*) AS n FROM u GROUP BY 1,2,3), c AS (SELECT *, m/greatest(sqrt(sum(m*m) OVER (PARTITION BY label,night)),1e-9) AS c FROM m),
s AS (SELECT vec_id, label, night, any_value(n) AS n, row_number() OVER (PARTITION BY label,night ORDER BY sum(v*c) DESC, vec_id) AS r FROM u JOIN c USING(label,night,i) GROUP BY 1,2,3),
k AS (SELECT label, night, i, avg(v) AS m, any_value(n) AS n FROM u JOIN s USING(vec_id,label,night) WHERE n<=3 OR r<=greatest(3, round_even(0.75*n,0)) GROUP BY 1,2,3) SELECT label, night, n, i::INT AS i, round(m/greatest(sqrt(sum(m*m) OVER (PARTITION BY label,night)),1e-9),6) AS m FROM k""")
def trimmed_centroid(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "embeddings").withColumn("night", F.col("vec_id") % 8)
    c = V.trimmed_centroids(e, ["label", "night"], "vec_id", "embedding")
    return c.select("label", "night", "n", F.posexplode("centroid").alias("i", "m")).withColumn("m", F.round("m", 6))


@query()
def split_labels(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "embeddings").withColumn("night", F.col("vec_id") % 8)
    return V.split_labels(e, ["label", "night"], "vec_id", "embedding")


@query(f"""SELECT doc_id, len(list_filter(string_split({"trim(regexp_replace(text, '\\s+', ' ', 'g'))"}, ' '), lambda x: x<>''))::INT AS words, length(text)::INT AS chars, (length(text)<200) AS short FROM documents""")
def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    words = F.size(F.filter(F.split(T.clean(F.col("text")), " "), lambda w: w != ""))
    return table(spark, folder, "documents").select("doc_id", words.alias("words"), F.length("text").alias("chars"), (F.length("text") < 200).alias("short"))


@query("SELECT kind, count(*) AS n, max(date) AS latest, max_by(doc_id, (coalesce(date,''), doc_id)) AS latest_id FROM documents GROUP BY 1")
def corpus_facts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("latest"), F.max_by("doc_id", F.struct(F.coalesce("date", F.lit("")), "doc_id")).alias("latest_id"))
