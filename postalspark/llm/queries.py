"""The registered queries of the training-data operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan
    return scan(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import COUNTS, judge
    got = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", *COUNTS, "base_failed", "kept")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import remove_repeats
    got = remove_repeats(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import KINDS, find
    d = find(table(spark, sf_dir, "documents"))
    place = F.array(*map(F.lit, KINDS))

    def joined(spans):
        rows = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), F.array_position(place, s["kind"]).alias("k"),
                                                     s["end"].alias("b"), s["kind"].alias("kind")))
        return F.array_join(F.transform(F.array_sort(rows), lambda s: F.concat_ws(":", s["kind"], s["a"], s["b"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return d.select("doc_id", *map(count, KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                    joined(F.array_distinct(F.concat("base", "added"))).alias("spans"),
                    F.size("added").cast("long").alias("n_added"))


def held_out(doc_id):
    """Rows that are only scored, never learned from: crc32 of the id's text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import labelled, learn, score
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    sample = labelled(docs, labels.where(~held_out(F.col("doc_id"))))
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    grammar = learn(sample, F.when(rest == 3, 2).otherwise(rest).cast("int"))
    return score(docs, grammar).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import rates
    return rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import compare_with_next
    return compare_with_next(table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls
    return filter_urls(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .negatives import mine
    vec_id = F.col("vec_id")
    shifted = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, shifted, scale=256)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings"), k=32, scale=64, offset=1_000_000)


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def _url_oracle() -> str:
    """DuckDB statement of `op10_url_filters`: rules as a CASE, terms as boundary patterns."""
    import re

    from .url_filter import RULES, SOFT_TERMS, STRICT_TERMS

    def hit(term: str) -> str:
        return f"regexp_matches(seen, '(^|[^a-z0-9]){re.escape(term)}([^a-z0-9]|$)')"

    fits = []
    for verdict, rule in sorted(RULES, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')", rule, verdict))
    soft = {t: w for t, w in SOFT_TERMS.items() if t not in STRICT_TERMS}
    n_strict = " + ".join(f"CAST({hit(t)} AS INTEGER)" for t in STRICT_TERMS)
    n_soft = " + ".join(f"CAST({hit(t)} AS INTEGER)" for t in soft)
    weight = " + ".join(f"CASE WHEN {hit(t)} THEN {float(w)}::DOUBLE ELSE 0::DOUBLE END" for t, w in soft.items())
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits) + " END"
    fixed = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits) + " END"
    return f"""WITH cut AS (SELECT page_id, lower(url_decode(coalesce(url, ''))) AS seen,
  CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, seen, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
counted AS (SELECT page_id, host, path, {rule} AS rule, {fixed} AS fixed, CAST({n_strict} AS INTEGER) AS n_strict,
  CAST({n_soft} AS INTEGER) AS n_soft, {weight} AS soft_weight FROM parts)
SELECT page_id, host, path, rule, coalesce(fixed, CASE WHEN n_strict >= 1 OR (n_soft >= 2 AND soft_weight >= 1.5)
  THEN 'block' ELSE 'allow' END) AS verdict, n_strict, n_soft, soft_weight FROM counted"""


def _vectors_sql(scale: int, columns: str) -> str:
    return f"""v AS (SELECT {columns}, list_transform(embedding, lambda c: floor({scale} * CAST(c AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(CAST(c AS DOUBLE)))) = 0)"""


def _negatives_oracle() -> str:
    """DuckDB statement of `op11_hard_negatives`: all scores of all anchors."""
    label = "CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS INTEGER) AS label"
    return f"""WITH {_vectors_sql(256, f"vec_id, {label}")},
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, c.vec_id, c.label, CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0 AND a.label IS NOT NULL AND c.label IS NOT NULL),
p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.own AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10"""


def _top_k_oracle() -> str:
    """DuckDB statement of `op13_exact_top_k`: all scores of all queries."""
    return f"""WITH {_vectors_sql(1024, "vec_id")}
SELECT q.vec_id AS query_id, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.x, c.x) DESC, c.vec_id) AS INTEGER) AS rank,
  c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 QUALIFY rank <= 10"""


def oracles() -> dict[str, str]:
    """Statements where portable SQL can express the whole result; the others are tested against plain versions."""
    return {"op10_url_filters": _url_oracle(), "op11_hard_negatives": _negatives_oracle(), "op13_exact_top_k": _top_k_oracle()}
