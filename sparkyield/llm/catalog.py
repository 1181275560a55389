"""Registered queries of this subpackage."""

from __future__ import annotations

import public_tokenizers

from sparkyield.llm import (
    bpe,
    classify,
    decontaminate,
    licenses,
    lines,
    merkle,
    packing,
    ppm,
    quality,
    repeats,
    resample,
    sharding,
    simhash,
)
from sparkyield.llm.common import benchmark, documents, labels

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def byte_bpe() -> str:
    """Place of the vocabulary file on this machine."""
    return public_tokenizers.path("byte_bpe_50k.json")


SHARDS = 24


@query("op1_sharding")
def op1_sharding(spark, sf_dir):
    return sharding.shard_table(documents(spark, sf_dir), SHARDS)


@query("op2_bpe")
def op2_bpe(spark, sf_dir):
    return bpe.digests(documents(spark, sf_dir), byte_bpe())


@query("op3_decontamination")
def op3_decontamination(spark, sf_dir):
    return decontaminate.contaminations(documents(spark, sf_dir), benchmark(spark, sf_dir))


@query("op4_line_dedup")
def op4_line_dedup(spark, sf_dir):
    return lines.summary(documents(spark, sf_dir))


@query("op5_simhash")
def op5_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


@query("op6_packing")
def op6_packing(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.digests(documents(spark, sf_dir), path)


@query("op7_quality_rules")
def op7_quality_rules(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return quality.apply_rules(docs).drop("text", "source")


@query("op8_quality_ranking")
def op8_quality_ranking(spark, sf_dir):
    return classify.rank(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op10_repeated_bytes")
def op10_repeated_bytes(spark, sf_dir):
    return repeats.digests(documents(spark, sf_dir))


@query("op9_license_scan")
def op9_license_scan(spark, sf_dir):
    return licenses.scan(documents(spark, sf_dir))


#: unsigned crc32 of a text without characters over one byte, bit by bit
CRC32 = (
    "xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, "
    "list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)), lambda x, b: "
    "list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))))"
)


def _tree_sql(name: str, base: str, levels: int) -> str:
    """Nodes and runs of ``levels`` levels above the table ``base (g, i, n, h)``, and their ends."""
    out = [f"{name}0 AS (SELECT g, i, n, h FROM {base})"]
    for k in range(levels):
        out.append(f"{name}r{k} AS (SELECT g, i // 16 AS r, list(h ORDER BY i) AS hs FROM {name}{k} WHERE n > 1 GROUP BY 1, 2)")
        out.append(f"{name}{k + 1} AS (SELECT g, i // 16 AS i, (n + 15) // 16 AS n, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}{k} WHERE n > 1 GROUP BY 1, 2, 3)")
    ends = " UNION ALL ".join(f"SELECT g, h FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
    return ", ".join([*out, f"{name}e AS ({ends})"])


def _walk_sql(name: str, base: str, levels: int) -> str:
    """Rows of ``base (g, i, n, acc, proof, ...)`` folded up to the end of their tree."""
    out, last = [], base
    for k in range(levels):
        out.append(
            f"{name}w{k} AS (SELECT * EXCLUDE (b, a) REPLACE (i // 16 AS i, CASE WHEN n > 1 THEN (n + 15) // 16 ELSE n END AS n, "
            "CASE WHEN n > 1 THEN sha256(b || acc || a) ELSE acc END AS acc, CASE WHEN n > 1 THEN proof || b || a ELSE proof END AS proof) "
            f"FROM (SELECT t.*, array_to_string(hs[1:t.i % 16], '') AS b, array_to_string(hs[t.i % 16 + 2:], '') AS a FROM {last} t LEFT JOIN {name}r{k} x ON x.g IS NOT DISTINCT FROM t.g AND x.r = t.i // 16 AND t.n > 1))"
        )
        last = f"{name}w{k}"
    return ", ".join(out)


_BYTES = "list_transform(range(0, strlen({0})), lambda i: ('0x' || substr(hex({0}), 2 * i + 1, 2))::BIGINT)"
_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
_CRC_WORD = CRC32.replace("list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)", _BYTES)
RESAMPLE_SQL = f"""WITH dw AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS ws FROM documents),
dx AS (SELECT r, unnest(ws) AS w FROM dw), tx AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
v AS (SELECT w, {_CRC_WORD.format('w')} % 10000 AS bucket FROM (SELECT w FROM dx UNION SELECT w FROM tx)),
s AS (SELECT bucket, count(*) AS s FROM dx JOIN v USING (w) GROUP BY 1), t AS (SELECT bucket, count(*) AS t FROM tx JOIN v USING (w) GROUP BY 1),
gain AS (SELECT b AS bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dx)::DOUBLE + 10000)) / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM tx)::DOUBLE + 10000))))::BIGINT AS g
 FROM range(10000) x(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
wt AS (SELECT r, sum(g)::BIGINT AS weight FROM dx JOIN v USING (w) JOIN gain USING (bucket) GROUP BY 1),
sc AS (SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM dw LEFT JOIN wt USING (r)),
rk AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS k, count(*) FILTER (n_features >= 20) OVER () AS n FROM sc)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= 10 * n // 100 THEN k END AS rank FROM rk"""
_ENC = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LOW = f"CASE WHEN {CRC32.format('doc_id::VARCHAR')} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
_HEAD = " || ".join(_ENC.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
MERKLE_SQL = f"""WITH d AS (SELECT doc_id, source, sha256({_HEAD} || {_ENC.format('text')}) AS h, sha256({_HEAD} || {_ENC.format(f'({_LOW})')}) AS tried FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d),
leaves AS (SELECT source AS g, i, n, h FROM o), {_tree_sql('s', 'leaves', 6)},
sub AS (SELECT g AS source, h, 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM se), {_tree_sql('t', 'sub', 5)},
go AS (SELECT source AS g, i, n, tried AS acc, '' AS proof, doc_id, h AS leaf FROM o), {_walk_sql('s', 'go', 6)},
up AS (SELECT 0 AS g, sub.i, sub.n, w.acc, w.proof, w.doc_id, w.leaf, sub.h AS subroot FROM sw5 w JOIN sub ON sub.source IS NOT DISTINCT FROM w.g), {_walk_sql('t', 'up', 5)}
SELECT doc_id, leaf, subroot, te.h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = te.h AS verified FROM tw4, te"""


@query("op11_merkle_manifest", MERKLE_SQL)
def op11_merkle_manifest(spark, sf_dir):
    return merkle.audit(documents(spark, sf_dir)).drop("n_steps")


@query("op13_importance_resampling", RESAMPLE_SQL)
def op13_importance_resampling(spark, sf_dir):
    return resample.resample(documents(spark, sf_dir), benchmark(spark, sf_dir))


@query("op12_lm_scoring")
def op12_lm_scoring(spark, sf_dir):
    return ppm.score(documents(spark, sf_dir))
