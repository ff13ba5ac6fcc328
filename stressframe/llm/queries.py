"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stressframe.llm import bpe, crosstok, decontam, jaccard, licences, lines, lloyd, lmscore, multiindex, pages, phrases, quality, substring

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text."""
    return quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, h, (length(h) // 2)::BIGINT AS n FROM d),
w AS (SELECT doc_id, pos, substr(h, 2 * pos + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS pos FROM g)),
f AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY s ORDER BY doc_id, pos) AS k FROM w),
a AS (SELECT doc_id, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 100 THEN 0 ELSE 1 END AS new FROM f WHERE k > 1),
i AS (SELECT doc_id, pos, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM a),
r AS (SELECT doc_id, run, min(pos) AS lo, max(pos) + 100 AS hi FROM i GROUP BY doc_id, run),
k AS (SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS start, lo AS stop FROM r
      UNION ALL SELECT g.doc_id, coalesce(max(r.hi), 0), any_value(g.n) FROM g LEFT JOIN r ON r.doc_id = g.doc_id GROUP BY g.doc_id),
t AS (SELECT k.doc_id, string_agg(substr(g.h, 2 * start + 1, 2 * (stop - start)), '' ORDER BY start) AS kept FROM k JOIN g ON g.doc_id = k.doc_id GROUP BY k.doc_id)
SELECT g.doc_id, g.n AS n_bytes, (g.n - length(t.kept) // 2)::BIGINT AS n_removed,
       (SELECT count(*) FROM r WHERE r.doc_id = g.doc_id)::BIGINT AS n_spans, sha256(unhex(t.kept)) AS kept_sha256
FROM g JOIN t ON t.doc_id = g.doc_id
"""


@query("op2_repeated_bytes", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by a 100-byte string that starts earlier go."""
    from pyspark.sql import functions as F

    left = substring.dedup_substrings(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents within their edit budget."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_lm_score")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every whole text: documents labelled good against all."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lmscore.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


@query("op5_licence_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence scan of every whole text: base phrases, labels and score."""
    return licences.scan(table(spark, sf_dir, "documents")).drop("spans")


@query("op6_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text."""
    return phrases.fingerprint_next(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) END) AS t FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n n1 ON n1.doc_id = x JOIN n n2 ON n2.doc_id = y WHERE 100 * c >= 85 * (n1.n + n2.n - c)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS low FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(m.low, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN m ON m.a = w.doc_id
"""


@query("op7_jaccard_join", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of every whole text."""
    return jaccard.link_near(table(spark, sf_dir, "documents")).drop("class_id")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT doc_id, line, pos,
       translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.doc_id, k.line, k.pos, (f.key IS NOT NULL AND k.doc_id <> f.first_doc) AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op8_line_dedup", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that repeat across documents stay in the first document only."""
    from pyspark.sql import functions as F

    left = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


@query("op9_html_extraction")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.main_text(table(spark, sf_dir, "pages"))


@query("op10_byte_bpe")
def op10(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Byte-level BPE of every whole text and back.  ``vocabulary``: path of a tokenizer file."""
    import public_tokenizers

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def _op11_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Complete rescans: the same codes as the active-entry rounds."""
    fine = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    steps = [
        f"k AS (SELECT vec_id, label, embedding AS v FROM embeddings WHERE {fine})",
        f"u AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i, len(v) // {parts} AS w FROM k)",
        "c AS (SELECT vec_id, i // w AS p, i % w AS j, CAST(floor(256 * x::DOUBLE) AS BIGINT) AS x FROM u)",
        f"f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT {entries})",
        "b0 AS (SELECT p, e, j, x FROM c JOIN f USING (vec_id))",
    ]
    for r in range(rounds + 1):
        steps += [
            f"d{r} AS (SELECT c.vec_id, c.p, b.e, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d FROM c JOIN b{r} b ON b.p = c.p AND b.j = c.j GROUP BY ALL)",
            f"a{r} AS (SELECT vec_id, p, e, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) AS k FROM d{r}) WHERE k = 1)",
        ]
        if r < rounds:
            steps += [
                f"m{r} AS (SELECT c.p, a.e, c.j, sum(c.x)::BIGINT AS s, count(*) AS n FROM c JOIN a{r} a ON a.vec_id = c.vec_id AND a.p = c.p GROUP BY ALL)",
                f"b{r + 1} AS (SELECT b.p, b.e, b.j, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.x) AS x"
                f" FROM b{r} b LEFT JOIN m{r} m ON m.p = b.p AND m.e = b.e AND m.j = b.j)",
            ]
    steps += [
        f"h AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM b{rounds})",
        f"o AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)",
    ]
    return "WITH " + ",\n".join(steps) + (
        "\nSELECT o.vec_id, code, error, (sum(error) OVER (PARTITION BY k.label))::BIGINT AS label_error, codebooks_sha256"
        " FROM o JOIN k ON k.vec_id = o.vec_id CROSS JOIN h"
    )


@query("op11_active_lloyd", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all finite vectors by active-entry Lloyd rounds."""
    return lloyd.codes_with_errors(table(spark, sf_dir, "embeddings"))


OP12_SQL = r"""
WITH RECURSIVE
k AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM k a JOIN k b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
r(a, b) AS (SELECT x, y FROM l UNION SELECT r.a, l.y FROM r JOIN l ON r.b = l.x),
m AS (SELECT a, min(b) AS low FROM r GROUP BY a),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(m.low, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(m.low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.x = e.vec_id LEFT JOIN m ON m.a = e.vec_id
"""


@query("op12_multi_index", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors and their components."""
    return multiindex.link_near(table(spark, sf_dir, "embeddings"))


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str, byte_json: str | None = None, piece_model: str | None = None) -> DataFrame:
    """Aligned tokens of every whole text under two tokenizers.  The paths are parameters."""
    import public_tokenizers

    a = byte_json or public_tokenizers.path("byte_bpe_50k.json")
    b = piece_model or public_tokenizers.path("piece_bpe_32k.model")
    return crosstok.align(table(spark, sf_dir, "documents"), a, b)
