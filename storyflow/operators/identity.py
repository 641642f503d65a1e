"""Who is who: candidates, mappings, the rolling cluster fold and reviews."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X

#: Below this a match is split off as new; below the second it is flagged.
SPLIT_BELOW, FLAG_BELOW = 50, 80


def first_by_name(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """The first row of each normalised name of a key; blank names fall away.
    Adds ``norm`` and ``n_same``, how many rows of the key share the name."""
    d = df.withColumn("norm", X.normalize_name(F.col(name))).where("norm <> ''")
    same = W.partitionBy(*keys, "norm")
    return d.withColumns({"_n": F.row_number().over(same.orderBy(*order)), "n_same": F.count(F.lit(1)).over(same)}).where("_n = 1").drop("_n")


def dedup_mappings(mappings: DataFrame, candidates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Mappings of names that are candidates of the same key, the first for each
    name, with the candidate's own spelling as ``temp_name``.

    ``mappings`` has ``temp_name_in_chunk``; ``candidates`` has ``norm`` and
    ``temp_name`` and one row for each name of a key.
    """
    m = mappings.withColumn("norm", X.normalize_name(F.col("temp_name_in_chunk"))).where("coalesce(temp_name_in_chunk, '') <> ''")
    known = m.join(candidates.select(*keys, "norm", "temp_name"), [*keys, "norm"])
    n = F.row_number().over(W.partitionBy(*keys, "norm").orderBy(*order))
    return known.withColumn("_n", n).where("_n = 1").drop("_n")


def fold_clusters(decisions: DataFrame, key: str = "run_id", order: str = "p", split_below: float = SPLIT_BELOW, flag_below: float = FLAG_BELOW, made_before: str | None = None) -> DataFrame:
    """(key, order, cluster_id, is_new, low_conf): the rolling decision fold.

    A decision ``match_result`` is NEW or names a cluster; one that names none
    of the clusters made so far, or whose ``confidence_score`` is below ``split_below``
    (null counts as 100), makes a new one; from there to below ``flag_below`` it
    merges and is flagged. Each key's
    rows pass through in order with one counter as state: a key is one task's
    work by its nature, but it is streamed, never collected. The column
    ``made_before`` says how many clusters a key had before its first row.
    """
    kinds = dict(decisions.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, made = None, 0
        pattern = re.compile(r"cluster_([0-9]{4,})\Z")
        for b in batches:
            cid, new, low = [], [], []
            for k, match, conf, before in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()):
                if k != now:
                    now, made = k, before or 0
                conf = 100 if conf is None else conf
                m = pattern.match((match or "").strip())
                number = int(m[1]) if m else 0
                fits = m is not None and 1 <= number <= made and m[1] == f"{number:04d}" and conf >= split_below
                if not fits:
                    made += 1
                    number = made
                cid.append(f"cluster_{number:04d}")
                new.append(not fits)
                low.append(fits and conf < flag_below)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cid, pa.string()), pa.array(new, pa.bool_()), pa.array(low, pa.bool_())], names=[key, order, "cluster_id", "is_new", "low_conf"])

    before = (F.col(made_before) if made_before else F.lit(0)).cast("bigint").alias("made_before")
    ordered = decisions.select(key, order, "match_result", "confidence_score", before).repartition(key).sortWithinPartitions(key, order)
    return ordered.mapInArrow(run, f"{key} {kinds[key]}, {order} {kinds[order]}, cluster_id string, is_new boolean, low_conf boolean")


def clusters(sightings: DataFrame, key: str = "run_id", order: str = "p") -> DataFrame:
    """(key, cluster_id, n, first_name, first_desc, names): one row for each
    cluster; ``names`` are its distinct names by norm in the order first seen."""
    first = first_by_name(sightings, [key, "cluster_id"], [order], "temp_name")
    names = first.groupBy(key, "cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(order, "temp_name", "norm"))), lambda s: F.struct(s["norm"].alias("norm"), s["temp_name"].alias("name"))).alias("names"))
    base = sightings.groupBy(key, "cluster_id").agg(
        F.count(F.lit(1)).alias("n"), F.min_by(F.struct("temp_name", "descr"), order).alias("f")
    ).select(key, "cluster_id", "n", F.col("f.temp_name").alias("first_name"), F.col("f.descr").alias("first_desc"))
    return base.join(names, [key, "cluster_id"], "left")


def valid_preserved(asked: Column, names: Column) -> Column:
    """The asked-for names that the cluster bears, in the cluster's spelling,
    each once, in the order asked; invented ones fall away."""
    norms = F.array_distinct(F.filter(F.transform(F.coalesce(asked, F.array().cast("array<string>")), X.normalize_name), lambda n: n != ""))
    found = F.transform(norms, lambda n: F.get(F.filter(names, lambda x: x["norm"] == n), F.lit(0))["name"])
    return F.filter(found, lambda x: x.isNotNull())


def review(bank: DataFrame, reviews: DataFrame, key: str = "run_id") -> DataFrame:
    """Final name, description, preserved names and status of every cluster.

    A cluster without a review falls back to its first name in brackets and
    preserves all its names; a blank name or description in a review falls back
    to the first sighting's.
    """
    j = bank.join(reviews.withColumn("_got", F.lit(True)), [key, "cluster_id"], "left")
    got = F.coalesce("_got", F.lit(False))
    fallback = F.concat(F.lit("["), F.col("first_name"), F.lit("]"))
    every = F.array_distinct(F.transform("names", lambda x: x["name"]))
    return j.select(
        key, "cluster_id", "n",
        F.when(got, F.coalesce(F.nullif("final_global_name", F.lit("")), fallback)).otherwise(fallback).alias("final_name"),
        F.when(got, F.coalesce(F.nullif("refined_visual_description", F.lit("")), F.col("first_desc"))).otherwise(F.col("first_desc")).alias("final_desc"),
        F.when(got, valid_preserved(F.col("preserve_temp_names"), F.col("names"))).otherwise(every).alias("preserved"),
        F.when(got, F.lit("ok")).otherwise(F.lit("fallback")).alias("status"),
    )


def chunk_pairs(sightings: DataFrame, final: DataFrame, keys: list[str], order: str = "p", run: str = "run_id") -> DataFrame:
    """(keys..., pattern, table): the rewriting of each chunk's captions, from
    its names to the final names of their clusters, preserved names left out. A
    name without brackets is rewritten inside brackets too."""
    auth = sightings.groupBy(*keys, "temp_name").agg(F.max("cluster_id").alias("cluster_id"), F.min(order).alias("_o"))
    info = final.select(run, "cluster_id", "final_name", F.transform("preserved", X.normalize_name).alias("_keep"))
    j = auth.join(info, [run, "cluster_id"]).where("final_name <> '' and temp_name <> ''")
    j = j.where(~F.array_contains("_keep", X.normalize_name(F.col("temp_name"))))
    bare = F.btrim("temp_name")
    wrapped = F.when((bare != "") & ~(bare.startswith("[") & bare.endswith("]")), F.concat(F.lit("["), bare, F.lit("]")))
    old = F.filter(F.array(wrapped, F.col("temp_name")), lambda x: x.isNotNull())
    flat = j.select(*keys, "_o", "final_name", F.posexplode(old).alias("_i", "old"))
    n = F.row_number().over(W.partitionBy(*keys, "old").orderBy("_o", "_i"))
    one = flat.withColumn("_n", n).where("_n = 1")
    grouped = one.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_o", "_i", "old", "final_name"))).alias("ps"))
    return grouped.select(
        *keys, X.any_of(F.transform("ps", lambda p: p["old"])).alias("pattern"),
        F.map_from_arrays(F.transform("ps", lambda p: p["old"]), F.transform("ps", lambda p: p["final_name"])).alias("table"),
    )
