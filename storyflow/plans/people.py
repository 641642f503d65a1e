"""Registered queries about identities, reviews and rewriting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..common import cut
from ..functions import text as X
from ..operators import identity as I
from ..operators.pieces import numbered
from ..operators import sampling as S
from ..sources import adapters as A
from . import sqlparts as P

D = DataFrame
CHUNK = ["run_id", "ch_idx"]
PLACE = ["ev_pos", "c_pos"]


def name_normalize(spark: SparkSession, d: str) -> D:
    n = A.sightings(spark, d).select(F.explode(F.array("temp_name", F.concat(F.lit(" 【"), "temp_name", F.lit("》\n")))).alias("name")).distinct()
    return n.select("name", X.normalize_name(F.col("name")).alias("norm"))


def _candidates(spark: SparkSession, d: str) -> D:
    return I.first_by_name(A.sightings(spark, d), CHUNK, PLACE, "temp_name")


def candidate_dedup(spark: SparkSession, d: str) -> D:
    return _candidates(spark, d).select(*CHUNK, *PLACE, "temp_name", "norm", "n_same")


def _placed(spark: SparkSession, d: str) -> D:
    """Computed once: rows and sizes of pieces, decisions and sightings all read it."""
    return cut(_numbered(spark, d))


def _numbered(spark: SparkSession, d: str) -> D:
    return numbered(_candidates(spark, d), "run_id", ["ch_idx", *PLACE], "p")


def _mappings(placed: D) -> D:
    """Recorded decisions of a matching model stand in as a rule over places."""
    p = F.col("p")
    own = F.struct(
        F.lit(0).alias("j"), F.when(p % 2 == 0, F.concat(F.lit("《"), "temp_name", F.lit(" "))).otherwise(F.concat(F.lit("【"), "norm", F.lit("】"))).alias("name"),
        F.when(p % 3 == 1, F.lit("NEW")).otherwise(F.format_string("cluster_%04d", (p * 7) % 9 + 1)).alias("m"), F.when(p % 7 != 0, (p * 37) % 101).alias("c"),
    )
    twice = F.when(p % 4 == 0, F.struct(F.lit(1).alias("j"), F.col("temp_name").alias("name"), F.lit("NEW").alias("m"), F.lit(10).alias("c")))
    ghost = F.when(p % 5 == 0, F.struct(F.lit(2).alias("j"), F.concat(F.lit("nobody "), p.cast("string")).alias("name"), F.lit("NEW").alias("m"), F.lit(90).alias("c")))
    x = placed.select("run_id", "ch_idx", "p", F.explode(F.filter(F.array(own, twice, ghost), lambda y: y.isNotNull())).alias("x"))
    return x.select("run_id", "ch_idx", "p", "x.j", F.col("x.name").alias("temp_name_in_chunk"), F.col("x.m").alias("match_result"), F.col("x.c").alias("confidence_score"))


def _kept(placed: D) -> D:
    return I.dedup_mappings(_mappings(placed), placed, CHUNK, ["p", "j"])


def mapping_dedup(spark: SparkSession, d: str) -> D:
    return _kept(_placed(spark, d)).select(*CHUNK, "p", "j", "temp_name", "match_result", "confidence_score")


def _folded(placed: D) -> D:
    return I.fold_clusters(_kept(placed))


def cluster_fold(spark: SparkSession, d: str) -> D:
    return _folded(_placed(spark, d))


def low_conf_flags(spark: SparkSession, d: str) -> D:
    placed = _placed(spark, d)
    k = _kept(placed).select("run_id", "p", "ch_idx", "temp_name", "confidence_score")
    return _folded(placed).where("low_conf").join(k, ["run_id", "p"]).select("run_id", "ch_idx", "temp_name", "cluster_id", "confidence_score")


def _sightings(spark: SparkSession, d: str) -> D:
    """Computed once: the fold's result feeds several branches of a query."""
    return cut(_joined(spark, d))


def _joined(spark: SparkSession, d: str) -> D:
    placed = _placed(spark, d)
    return placed.select("run_id", "p", "ch_idx", "temp_name", "descr", "anchor_ts").join(_folded(placed).select("run_id", "p", "cluster_id"), ["run_id", "p"])


def cluster_sightings(spark: SparkSession, d: str) -> D:
    g = _joined(spark, d).groupBy("run_id", "cluster_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("p", "temp_name"))).alias("s"))
    return g.select("run_id", "cluster_id", "n", F.array_join(F.transform("s", lambda x: F.concat(x["p"].cast("string"), F.lit(":"), x["temp_name"])), " | ").alias("sightings"))


def _bank(spark: SparkSession, d: str, sightings: D | None = None) -> D:
    return I.clusters(_sightings(spark, d) if sightings is None else sightings)


def name_history(spark: SparkSession, d: str) -> D:
    return _bank(spark, d).select("run_id", "cluster_id", F.array_join(F.transform("names", lambda x: x["name"]), ", ").alias("names"))


def review_sample(spark: SparkSession, d: str) -> D:
    b = _bank(spark, d).select("run_id", "cluster_id", "n")
    return b.select("run_id", "cluster_id", F.explode(S.even_sample(F.col("n").cast("int"), 3)).alias("place"))


def review_batches(spark: SparkSession, d: str) -> D:
    b = _bank(spark, d).select("run_id", "cluster_id")
    n = F.row_number().over(W.partitionBy("run_id").orderBy("cluster_id"))
    return b.select("run_id", "cluster_id", F.floor((n - 1) / 4).cast("int").alias("batch"))


def _reviews(bank: D) -> D:
    """Recorded reviews stand in as a rule over cluster numbers."""
    k = F.substring("cluster_id", 9, 9).cast("int")
    return bank.where(k % 3 != 0).select(
        "run_id", "cluster_id", F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("[person "), k.cast("string"), F.lit("]"))).alias("final_global_name"),
        F.when(k % 4 != 0, F.concat(F.lit("seen "), F.col("n").cast("string"), F.lit(" times"))).alias("refined_visual_description"),
        F.when(k % 2 == 0, F.array(F.concat(F.lit("<"), "first_name", F.lit(">")), F.lit("[ghost]"), F.col("first_name"))).alias("preserve_temp_names"),
    )


def pending_review(spark: SparkSession, d: str) -> D:
    b = cut(_bank(spark, d))
    return b.where("n > 0").join(_reviews(b), ["run_id", "cluster_id"], "left_anti").select("run_id", "cluster_id", "n")


def _final(spark: SparkSession, d: str, sightings: D | None = None) -> D:
    b = cut(_bank(spark, d, sightings))
    return I.review(b, _reviews(b))


def preserve_validate(spark: SparkSession, d: str) -> D:
    f = _final(spark, d).where("status = 'ok'")
    return f.select("run_id", "cluster_id", F.array_join("preserved", ", ").alias("preserved"))


def review_fallback(spark: SparkSession, d: str) -> D:
    return _final(spark, d).select("run_id", "cluster_id", "final_name", "final_desc", F.array_join("preserved", ", ").alias("preserved"), "status")


def cluster_bank(spark: SparkSession, d: str) -> D:
    f = _final(spark, d)
    return f.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_clusters"), F.sum("n").alias("n_sightings"), F.count_if(F.col("status") == "fallback").alias("n_fallback"), F.max(F.size("preserved")).alias("most_preserved"))


def sighting_override(spark: SparkSession, d: str) -> D:
    return _joined(spark, d).groupBy(*CHUNK, "temp_name").agg(F.max("cluster_id").alias("cluster_id"))


def resolved_candidates(spark: SparkSession, d: str) -> D:
    s = _sightings(spark, d)
    auth = s.groupBy(*CHUNK, "temp_name").agg(F.max("cluster_id").alias("cluster_id"))
    info = _final(spark, d, s).select("run_id", "cluster_id", "final_name")
    c = A.sightings(spark, d).select(*CHUNK, *PLACE, "temp_name")
    return c.join(auth, [*CHUNK, "temp_name"], "left").join(info, ["run_id", "cluster_id"], "left").select(*CHUNK, *PLACE, "temp_name", "cluster_id", "final_name")


def _rewritten(spark: SparkSession, d: str) -> D:
    s = _sightings(spark, d)
    pairs = I.chunk_pairs(s, _final(spark, d, s), CHUNK)
    c = A.pairs(spark, d, "ch_idx", "step3_synthesized_dense_caption").withColumnRenamed("step3_synthesized_dense_caption", "caption")
    j = c.join(pairs, CHUNK, "left")
    hits = F.coalesce(F.size(F.regexp_extract_all("caption", F.col("pattern"), F.lit(0))), F.lit(0))
    return j.withColumns({"rewritten": X.rewrite(F.col("caption"), F.col("pattern"), F.col("table")), "hits": F.when(F.col("pattern").isNull() | F.col("caption").isNull(), 0).otherwise(hits)})


def caption_rewrite(spark: SparkSession, d: str) -> D:
    return _rewritten(spark, d).select("run_id", "event_id", "rewritten")


def rewrite_hits(spark: SparkSession, d: str) -> D:
    return _rewritten(spark, d).groupBy("run_id").agg(F.sum("hits").alias("n_hits"))


def bounded_replace(spark: SparkSession, d: str) -> D:
    c = A.pairs(spark, d, "step3_synthesized_dense_caption").withColumnRenamed("step3_synthesized_dense_caption", "caption")
    name = F.get(X.mentions(F.col("caption")), F.lit(0))
    return c.select("run_id", "event_id", X.bounded_replace(F.col("caption"), name, F.lit("<$1\\name>")).alias("replaced"))


QUERIES = {
    f.__name__: f
    for f in (
        name_normalize, candidate_dedup, mapping_dedup, cluster_fold, low_conf_flags, cluster_sightings, name_history, review_sample, review_batches, pending_review,
        preserve_validate, review_fallback, cluster_bank, sighting_override, resolved_candidates, caption_rewrite, rewrite_hits, bounded_replace,
    )
}

_CAND = (
    f"{P.SIGHTINGS},cd AS (SELECT run_id,ch_idx,ev_pos,c_pos,temp_name,descr,anchor_ts,norm,n_same FROM (SELECT *,row_number() OVER (PARTITION BY run_id,ch_idx,norm ORDER BY ev_pos,c_pos) AS n,"
    f"count(*) OVER (PARTITION BY run_id,ch_idx,norm) AS n_same FROM (SELECT *,{P.norm('temp_name')} AS norm FROM sg) WHERE norm<>'') WHERE n=1)"
)
_PLACED = f"{_CAND},pc AS (SELECT *,row_number() OVER (PARTITION BY run_id ORDER BY ch_idx,ev_pos,c_pos) AS p FROM cd)"
_KEPT = (
    f"{_PLACED},mp AS (SELECT run_id,ch_idx,p,0 AS j,CASE WHEN p%2=0 THEN '《'||temp_name||' ' ELSE '【'||norm||'】' END AS nm,CASE WHEN p%3=1 THEN 'NEW' ELSE printf('cluster_%04d',(p*7)%9+1) END AS match_result,"
    "CASE WHEN p%7<>0 THEN (p*37)%101 END AS confidence_score FROM pc"
    " UNION ALL SELECT run_id,ch_idx,p,1,temp_name,'NEW',10 FROM pc WHERE p%4=0 UNION ALL SELECT run_id,ch_idx,p,2,'nobody '||p,'NEW',90 FROM pc WHERE p%5=0),"
    f"kp AS (SELECT m.run_id,m.ch_idx,m.p,m.j,c.temp_name,m.match_result,m.confidence_score FROM (SELECT *,{P.norm('nm')} AS norm FROM mp) m JOIN cd c USING (run_id,ch_idx,norm)"
    " QUALIFY row_number() OVER (PARTITION BY m.run_id,m.ch_idx,norm ORDER BY m.p,m.j)=1)"
)
_FOLD = (
    f"WITH RECURSIVE {_KEPT},sq AS (SELECT *,row_number() OVER (PARTITION BY run_id ORDER BY p) AS i,CASE WHEN match_result<>'NEW' THEN CAST(substr(match_result,9) AS INT) ELSE 0 END AS k,COALESCE(confidence_score,100) AS cf FROM kp),"
    "fo AS (SELECT run_id,p,i,1 AS made,1 AS k,true AS is_new,false AS low_conf FROM sq WHERE i=1"
    " UNION ALL SELECT s.run_id,s.p,s.i,CASE WHEN s.k BETWEEN 1 AND f.made AND s.cf>=50 THEN f.made ELSE f.made+1 END,CASE WHEN s.k BETWEEN 1 AND f.made AND s.cf>=50 THEN s.k ELSE f.made+1 END,"
    "NOT (s.k BETWEEN 1 AND f.made AND s.cf>=50),(s.k BETWEEN 1 AND f.made AND s.cf>=50) AND s.cf<80 FROM fo f JOIN sq s ON s.run_id=f.run_id AND s.i=f.i+1),"
    "fd AS (SELECT run_id,p,printf('cluster_%04d',k) AS cluster_id,is_new,low_conf FROM fo)"
)
_SIGHT = f"{_FOLD},si AS (SELECT pc.run_id,pc.p,pc.ch_idx,pc.temp_name,pc.descr,fd.cluster_id FROM pc JOIN fd USING (run_id,p))"
_BANK = (
    f"{_SIGHT},fn AS (SELECT run_id,cluster_id,p,temp_name,{P.norm('temp_name')} AS norm FROM si WHERE {P.norm('temp_name')}<>'' QUALIFY row_number() OVER (PARTITION BY run_id,cluster_id,{P.norm('temp_name')} ORDER BY p)=1),"
    "na AS (SELECT run_id,cluster_id,list(struct_pack(norm:=norm,name:=temp_name) ORDER BY p) AS names FROM fn GROUP BY 1,2),"
    "ba AS (SELECT run_id,cluster_id,n,first_name,first_desc,names FROM (SELECT run_id,cluster_id,count(*) AS n,arg_min(struct_pack(a:=temp_name),p).a AS first_name,arg_min(struct_pack(a:=descr),p).a AS first_desc FROM si GROUP BY 1,2) LEFT JOIN na USING (run_id,cluster_id))"
)
_REV = (
    f"{_BANK},rv AS (SELECT run_id,cluster_id,CASE WHEN k%5=0 THEN '' ELSE '[person '||k||']' END AS nm,CASE WHEN k%4<>0 THEN 'seen '||n||' times' END AS ds,CASE WHEN k%2=0 THEN ['<'||first_name||'>','[ghost]',first_name] ELSE [] END AS kp"
    " FROM (SELECT *,CAST(substr(cluster_id,9) AS INT) AS k FROM ba) WHERE k%3<>0)"
)
_FINAL = (
    f"{_REV},pv AS (SELECT run_id,cluster_id,list(name ORDER BY o) AS pres FROM (SELECT r.run_id,r.cluster_id,n.name,min(o) AS o FROM (SELECT run_id,cluster_id,unnest(kp) AS a,unnest(range(len(kp))) AS o FROM rv) r"
    f" JOIN (SELECT run_id,cluster_id,unnest(names) AS n FROM ba) x ON x.run_id=r.run_id AND x.cluster_id=r.cluster_id AND x.n.norm={P.norm('r.a')} GROUP BY 1,2,3) GROUP BY 1,2),"
    "fi AS (SELECT ba.run_id,ba.cluster_id,n,CASE WHEN rv.run_id IS NULL THEN '['||first_name||']' ELSE COALESCE(nullif(nm,''),'['||first_name||']') END AS final_name,"
    "CASE WHEN rv.run_id IS NULL THEN first_desc ELSE COALESCE(nullif(ds,''),first_desc) END AS final_desc,"
    "CASE WHEN rv.run_id IS NULL THEN list_transform(names,lambda x: x.name) ELSE COALESCE(pres,[]) END AS preserved,CASE WHEN rv.run_id IS NULL THEN 'fallback' ELSE 'ok' END AS status"
    " FROM ba LEFT JOIN rv USING (run_id,cluster_id) LEFT JOIN pv USING (run_id,cluster_id))"
)
_FINAL = _FINAL.replace("n.name,min(o)", "x.n.name AS name,min(o)")
_REWRITE = (
    f"{_FINAL},au AS (SELECT run_id,ch_idx,temp_name,max(cluster_id) AS cluster_id,min(p) AS o FROM si GROUP BY 1,2,3),"
    f"pj AS (SELECT au.run_id,ch_idx,o,temp_name,final_name FROM au JOIN fi USING (run_id,cluster_id) WHERE final_name<>'' AND temp_name<>'' AND NOT list_contains(list_transform(preserved,lambda x: {P.norm('x')}),{P.norm('temp_name')})),"
    "po AS (SELECT run_id,ch_idx,o,0 AS i,'['||trim(temp_name)||']' AS old,final_name FROM pj WHERE trim(temp_name)<>'' AND NOT (starts_with(trim(temp_name),'[') AND ends_with(trim(temp_name),']')) UNION ALL SELECT run_id,ch_idx,o,1,temp_name,final_name FROM pj),"
    "pq AS (SELECT * FROM po QUALIFY row_number() OVER (PARTITION BY run_id,ch_idx,old ORDER BY o,i)=1),"
    "pt AS (SELECT run_id,ch_idx,string_agg(regexp_escape(old),'|' ORDER BY length(old) DESC,o,i) AS pat,map(list(old ORDER BY o,i),list(final_name ORDER BY o,i)) AS tab FROM pq GROUP BY 1,2),"
    f"{P.PAIRS},cp AS (SELECT pr.run_id,pr.event_id,step3_synthesized_dense_caption AS c,pat,tab FROM pr LEFT JOIN pt USING (run_id,ch_idx)),"
    "rw AS (SELECT run_id,event_id,CASE WHEN pat IS NULL OR c IS NULL THEN c ELSE (SELECT string_agg(s[k+1]||COALESCE(tab[h[k+1]],''),'' ORDER BY k) FROM (SELECT string_split_regex(c,pat) AS s,regexp_extract_all(c,pat) AS h),range(len(string_split_regex(c,pat))) r(k)) END AS rewritten,"
    "CASE WHEN pat IS NULL OR c IS NULL THEN 0 ELSE len(regexp_extract_all(c,pat)) END AS hits FROM cp)"
)

SQL = {
    "name_normalize": f"WITH {P.SIGHTINGS} SELECT DISTINCT nm AS name,{P.norm('nm')} AS norm FROM (SELECT unnest([temp_name,' 【'||temp_name||'》'||chr(10)]) AS nm FROM sg)",
    "candidate_dedup": f"WITH {_CAND} SELECT run_id,ch_idx,CAST(ev_pos AS INT) AS ev_pos,CAST(c_pos AS INT) AS c_pos,temp_name,norm,n_same FROM cd",
    "mapping_dedup": f"WITH {_KEPT} SELECT run_id,ch_idx,CAST(p AS INT) AS p,j,temp_name,match_result,CAST(confidence_score AS INT) AS confidence_score FROM kp",
    "cluster_fold": f"{_FOLD} SELECT run_id,CAST(p AS INT) AS p,cluster_id,is_new,low_conf FROM fd",
    "low_conf_flags": f"{_FOLD} SELECT run_id,ch_idx,temp_name,cluster_id,CAST(confidence_score AS INT) AS confidence_score FROM fd JOIN kp USING (run_id,p) WHERE low_conf",
    "cluster_sightings": f"{_SIGHT} SELECT run_id,cluster_id,count(*) AS n,string_agg(p||':'||temp_name,' | ' ORDER BY p) AS sightings FROM si GROUP BY 1,2",
    "name_history": f"{_BANK} SELECT run_id,cluster_id,array_to_string(list_transform(names,lambda x: x.name),', ') AS names FROM ba",
    "review_sample": f"{_BANK} SELECT DISTINCT run_id,cluster_id,CAST(k AS INT) AS place FROM (SELECT run_id,cluster_id,unnest(CASE WHEN n<=3 THEN range(n) ELSE [0,CAST(round_even((n-1)/2.0,0) AS BIGINT),n-1] END) AS k FROM ba)",
    "review_batches": f"{_BANK} SELECT run_id,cluster_id,CAST((row_number() OVER (PARTITION BY run_id ORDER BY cluster_id)-1)//4 AS INT) AS batch FROM ba",
    "pending_review": f"{_REV} SELECT run_id,cluster_id,n FROM ba WHERE NOT EXISTS (SELECT 1 FROM rv WHERE rv.run_id=ba.run_id AND rv.cluster_id=ba.cluster_id)",
    "preserve_validate": f"{_FINAL} SELECT run_id,cluster_id,array_to_string(preserved,', ') AS preserved FROM fi WHERE status='ok'",
    "review_fallback": f"{_FINAL} SELECT run_id,cluster_id,final_name,final_desc,array_to_string(preserved,', ') AS preserved,status FROM fi",
    "cluster_bank": f"{_FINAL} SELECT run_id,count(*) AS n_clusters,CAST(sum(n) AS BIGINT) AS n_sightings,count(*) FILTER (status='fallback') AS n_fallback,CAST(max(len(preserved)) AS INT) AS most_preserved FROM fi GROUP BY 1",
    "sighting_override": f"{_SIGHT} SELECT run_id,ch_idx,temp_name,max(cluster_id) AS cluster_id FROM si GROUP BY 1,2,3",
    "resolved_candidates": f"{_FINAL},au AS (SELECT run_id,ch_idx,temp_name,max(cluster_id) AS cluster_id FROM si GROUP BY 1,2,3) SELECT sg.run_id,sg.ch_idx,CAST(ev_pos AS INT) AS ev_pos,CAST(c_pos AS INT) AS c_pos,sg.temp_name,cluster_id,final_name FROM sg LEFT JOIN au USING (run_id,ch_idx,temp_name) LEFT JOIN fi USING (run_id,cluster_id)",
    "caption_rewrite": f"{_REWRITE} SELECT run_id,event_id,rewritten FROM rw",
    "rewrite_hits": f"{_REWRITE} SELECT run_id,CAST(sum(hits) AS BIGINT) AS n_hits FROM rw GROUP BY 1",
    # No look-behind here: the caption is cut at the name, and each place is judged by the parts beside it.
    "bounded_replace": (
        f"WITH {P.PAIRS},c AS (SELECT run_id,event_id,step3_synthesized_dense_caption AS t,regexp_extract_all(step3_synthesized_dense_caption,'{X.MENTION}')[1] AS name FROM pr),"
        "s AS (SELECT *,string_split(t,name) AS ps FROM c)"
        "SELECT run_id,event_id,CASE WHEN name IS NULL OR t IS NULL THEN t ELSE array_to_string(list_transform(range(1,len(ps)+1),lambda i: ps[i]||CASE WHEN i=len(ps) THEN ''"
        " WHEN regexp_matches(right(ps[i],1),'[\\p{L}\\p{N}_一-鿿]') OR regexp_matches(left(ps[i+1],1),'[\\p{L}\\p{N}_一-鿿]') THEN name ELSE '<$1\\name>' END),'') END AS replaced FROM s"
    ),
}
