"""Voices as vectors: centroids, decisions against a library, audits and the test for a label that holds two voices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.functions import vectors as X
from quorumlake.io import bounded_rows, built, send

# The gates of a decision.
FLOOR, MARGIN, Z_LEAST, NIGHT_FLOOR, LEAST_NIGHTS, LEAST_HITS = 0.50, 0.08, 3.0, 0.45, 2, 2


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, centroid, n): the mean by place, of vectors of one length.  Sums are made before the shuffle."""
    places = df.select(label, F.posexplode(X.doubles(F.col(vector))).alias("i", "x"))
    sums = places.groupBy(label, "i").agg(F.avg("x").alias("m"), F.count(F.lit(1)).alias("n"))
    return sums.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centroid"), F.max("n").alias("n"))


def night_centroids(df: DataFrame, label: str, night: str, vector: str) -> DataFrame:
    """(label, night, centroid, n): one unit vector for each voice and night."""
    both = centroids(df.withColumn("__k", F.struct(label, night)), "__k", vector)
    return both.select(F.col("__k").getField(label).alias(label), F.col("__k").getField(night).alias(night), X.unit(F.col("centroid")).alias("centroid"), "n")


def _rows_to_unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)


def judged(df: DataFrame, library: DataFrame, nights: DataFrame, key: str, label: str, night: str, vector: str, own: str | None = None, own_night: str | None = None, strangers: bool = False, most_labels: int = 10_000, most_nights: int = 200_000) -> DataFrame:
    """(key, best, score, runner_up, margin, z, nights, hits, verdict): each vector's two nearest voices and the decision.

    library: (label, centroid, n), nights: (label, night, centroid).  A vector with a label ``own`` is taken out of that label's
    centroid, and its night out of that label's nights; with ``strangers`` the whole label is taken out, as if the voice had
    never been enrolled.  Of equal scores the smaller label comes first.  The first gate that fails gives the verdict: the
    floor, the margin to the next (0 if there is none), the distance from the rest in their deviations (from three on), voices
    of one night, and hits on too few nights.  A vector without any voice to compare is "empty".

    Library and nights go to the executors after a check of their size.  Scores are one matrix product a batch, of which one
    row a vector is kept.
    """
    known = sorted(bounded_rows(library.select(label, "centroid", "n"), most_labels, "the library of voices"), key=lambda r: r[label])
    heard = sorted(bounded_rows(nights.select(label, night, "centroid"), most_nights, "the nights of voices"), key=lambda r: (r[label], str(r[night])))
    at = {r[label]: i for i, r in enumerate(known)}
    sent = send(df.sparkSession, ([r[label] for r in known], [r["centroid"] for r in known], [float(r["n"]) for r in known], [at.get(r[label], -1) for r in heard], [r[night] for r in heard], [r["centroid"] for r in heard]))
    kinds = {c: df.schema[c].dataType.simpleString() for c in (key,)} | {label: library.schema[label].dataType.simpleString()}

    def prepare(value):
        labels, means, sizes, of, when, each = value
        m = np.array(means, dtype=float).reshape(len(labels), -1)
        return np.array(labels, dtype=object), m, _rows_to_unit(m), np.array(sizes), np.array(of), np.array(when, dtype=object), np.array(each, dtype=float).reshape(len(of), -1), {x: i for i, x in enumerate(labels)}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labels, means, unit, sizes, of, when, each, place = built(sent, prepare)
        for batch in batches:
            v = np.array(batch["__v"].tolist(), dtype=float).reshape(len(batch), -1)
            u, rows = _rows_to_unit(v), np.arange(len(batch))
            s = u @ unit.T if len(labels) else np.empty((len(batch), 0))
            mine = np.array([place.get(x, -1) for x in batch["__own"]], dtype=int) if own else np.full(len(batch), -1)
            owned = np.flatnonzero(mine >= 0)
            if strangers:
                s[owned, mine[owned]] = -np.inf
            elif len(owned):
                some = owned[sizes[mine[owned]] > 1]
                rest = (means[mine[some]] * sizes[mine[some], None] - v[some]) / (sizes[mine[some], None] - 1)
                s[some, mine[some]] = (u[some] * _rows_to_unit(rest)).sum(axis=1)
            open_ = np.isfinite(s)
            n = open_.sum(axis=1)
            padded = np.concatenate([s, np.full((len(batch), 2), -np.inf)], axis=1)  # so that there is a second at all
            first = padded.argmax(axis=1)
            top = padded[rows, first]
            padded[rows, first] = -np.inf
            second = padded.argmax(axis=1)
            others = np.maximum(n - 1, 1)
            left = np.where(np.isfinite(padded[:, : s.shape[1]]), padded[:, : s.shape[1]], 0.0)
            mean = left.sum(axis=1) / others
            deviation = np.sqrt(np.where(np.isfinite(padded[:, : s.shape[1]]), (left - mean[:, None]) ** 2, 0.0).sum(axis=1) / others)
            counted = of[None, :] == first[:, None]
            if own_night:
                counted &= ~((of[None, :] == mine[:, None]) & (when[None, :] == batch["__night"].to_numpy(dtype=object)[:, None]))
            hits = (counted & (u @ each.T >= NIGHT_FLOOR)).sum(axis=1) if len(of) else np.zeros(len(batch), dtype=int)
            name = lambda i, ok: [labels[k] if y else None for k, y in zip(i, ok)]
            yield pd.DataFrame(
                {
                    key: batch[key].to_numpy(), "best": pd.Series(name(first, n > 0), dtype=object), "score": np.where(n > 0, top, np.nan), "runner_up": pd.Series(name(second, n > 1), dtype=object),
                    "margin": np.where(n > 0, top - np.where(n > 1, s[rows, np.minimum(second, max(s.shape[1] - 1, 0))] if s.shape[1] else 0.0, 0.0), np.nan),
                    "z": np.where(n > 3, (top - mean) / np.maximum(deviation, 1e-6), np.nan), "nights": counted.sum(axis=1), "hits": hits,
                }
            )

    named = df.select(key, X.doubles(F.col(vector)).alias("__v"), *([F.col(own).alias("__own")] if own else []), *([F.col(own_night).alias("__night")] if own_night else []))
    made = named.mapInPandas(score, f"{key} {kinds[key]}, best {kinds[label]}, score double, runner_up {kinds[label]}, margin double, z double, nights int, hits int")
    made = made.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("score", "margin", "z")})
    return made.withColumn("verdict", verdict())


def verdict(floor: float = FLOOR, margin: float = MARGIN) -> Column:
    """The first gate that fails, over the columns of ``judged``; else "named"."""
    return (
        F.when(F.col("score").isNull(), "empty").when(F.col("score") < floor, "below the floor").when(F.col("margin") < margin, "too close to the next")
        .when(F.col("z") < Z_LEAST, "not apart from the rest").when(F.col("nights") < LEAST_NIGHTS, "known from one night")
        .when(F.col("hits") < F.least(F.lit(LEAST_HITS), F.col("nights")), "heard on too few nights").otherwise("named")
    )


def trial_metrics(trials: DataFrame, truth: str, known_elsewhere: Column) -> DataFrame:
    """One row of a hold-one-out test: trials, nearest right, named, right, wrong, silent; and of the voices that can be found
    at all (``known_elsewhere``) how many are named rightly, of the others how many are declined."""
    named, right = F.col("verdict") == "named", F.col("best").eqNullSafe(F.col(truth))
    return trials.agg(
        F.count(F.lit(1)).alias("trials"), F.count_if(right).alias("nearest_right"), F.count_if(named).alias("named"), F.count_if(named & right).alias("right"), F.count_if(named & ~right).alias("wrong"),
        F.count_if(~named).alias("silent"), F.count_if(known_elsewhere).alias("findable"), F.count_if(known_elsewhere & named & right).alias("found"), F.count_if(~known_elsewhere & ~named).alias("declined"),
    )


def sweep(df: DataFrame, score: str, margin: str, right: Column, floors: list[float], margins: list[float]) -> DataFrame:
    """(floor, margin, named, right) for each pair of thresholds, in one pass: a count for each pair, then turned into rows."""
    counts = []
    for f in floors:
        for m in margins:
            ok = (F.col(score) >= f) & (F.col(margin) >= m)
            counts.append(F.struct(F.lit(f).alias("floor"), F.lit(m).alias("margin"), F.count_if(ok).alias("named"), F.count_if(ok & right).alias("right")))
    return df.agg(F.array(*counts).alias("x")).select(F.inline("x"))


def night_pairs(nights: DataFrame, label: str, night: str, most_nights: int = 5_000) -> DataFrame:
    """(label, mean, p05, p95, least, most, n) of the likeness of two nights of one voice.

    nights: (label, night, centroid), one row a night, as made by ``night_centroids``; a voice of more than
    ``most_nights`` nights is an error, as its pairs are one matrix product.
    """
    kind = nights.schema[label].dataType.simpleString()

    def measure(group: pd.DataFrame) -> pd.DataFrame:
        if len(group) > most_nights:
            raise ValueError(f"a voice has more than {most_nights} nights")
        v = np.array(group.sort_values(night)["centroid"].tolist(), dtype=float).reshape(len(group), -1)
        s = (v @ v.T)[np.triu_indices(len(v), 1)]
        rows = [(group[label].iloc[0], s.mean(), *np.percentile(s, [5, 95]), s.min(), s.max(), len(s))] if len(s) else []
        return pd.DataFrame(rows, columns=[label, "mean", "p05", "p95", "least", "most", "n"])

    return nights.select(label, night, "centroid").groupBy(label).applyInPandas(measure, f"{label} {kind}, mean double, p05 double, p95 double, least double, most double, n bigint")


def trimmed_centroids(df: DataFrame, keys: list[str], order: str, vector: str, share: float = 0.75, least: int = 3) -> DataFrame:
    """(keys, centroid, n): the unit mean of the ``share`` of unit vectors (``least`` at least) nearest to the first unit mean.

    Both means are sums by place, made before the shuffle; between them the vectors of a group are ranked by their
    likeness, ties by ``order``.  ``share * n`` is rounded half to even.
    """
    units = df.select(F.struct(*keys).alias("__g"), F.col(order).alias("__o"), X.unit(X.doubles(F.col(vector))).alias("__u"))
    first = centroids(units, "__g", "__u").select("__g", X.unit(F.col("centroid")).alias("__c"), "n")
    near = units.join(first, "__g").withColumn("__r", F.row_number().over(Window.partitionBy("__g").orderBy(F.desc(X.dot(F.col("__u"), F.col("__c"))), "__o")))
    kept = near.where((F.col("n") <= least) | (F.col("__r") <= F.greatest(F.lit(least), F.bround(share * F.col("n"), 0))))
    again = centroids(kept, "__g", "__u").select("__g", X.unit(F.col("centroid")).alias("centroid"))
    return again.join(first.select("__g", "n"), "__g").select(*(F.col("__g").getField(k).alias(k) for k in keys), "centroid", "n")


def two_voices(gram: np.ndarray, within: float = 0.55, between: float = 0.45, rounds: int = 60) -> bool:
    """Whether unit vectors, given by their likenesses, fall into two tight voices far from each other.

    Two means in kernel form: the likeness of a vector to a mean is the sum of its likenesses to the members over the length of
    their sum, so only the matrix is needed.  The two vectors least alike begin; at least six vectors and two a voice are asked
    for.
    """
    n = len(gram)
    if n < 6:
        return False
    member = np.zeros((n, 2))
    member[list(np.unravel_index(gram.argmin(), gram.shape)), [0, 1]] = 1
    for _ in range(rounds):
        lengths = np.sqrt(np.maximum(np.diag(member.T @ gram @ member), 1e-18))
        moved = np.eye(2)[(gram @ member / lengths).argmax(axis=1)]
        if (moved == member).all():
            break
        member = moved
        if not member.any(axis=0).all():
            return False
    sizes = member.sum(axis=0)
    if sizes.min() < 2:
        return False
    sums = member.T @ gram @ member
    tight = (np.diag(sums) - member.T @ np.diag(gram)) / (sizes * (sizes - 1))
    return bool(tight.min() >= within and sums[0, 1] / sizes.prod() <= between)


def split_labels(df: DataFrame, keys: list[str], order: str, vector: str, most_slices: int = 10_000) -> DataFrame:
    """(keys, split, n): whether the slices of one voice at one night are two voices.

    A few slices are cut for each voice and night; a group of more than ``most_slices`` is an error, as its likenesses are one
    matrix.
    """
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def audit(group: pd.DataFrame) -> pd.DataFrame:
        if len(group) > most_slices:
            raise ValueError(f"a voice has more than {most_slices} slices at one night")
        u = _rows_to_unit(np.array(group.sort_values(order)["__v"].tolist(), dtype=float).reshape(len(group), -1))
        return pd.DataFrame([(*(group[k].iloc[0] for k in keys), two_voices(u @ u.T), len(u))], columns=[*keys, "split", "n"])

    rows = df.select(*keys, *({order} - set(keys)), X.doubles(F.col(vector)).alias("__v"))
    return rows.groupBy(*keys).applyInPandas(audit, f"{kinds}, split boolean, n bigint")
