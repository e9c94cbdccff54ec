"""Registered queries of the training-data operators, with their DuckDB oracles where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.ann_forest import forest_search, usable
from ledgerlark.llm.centroids import centroid_clusters
from ledgerlark.llm.chat_format import chat_digests
from ledgerlark.llm.common import table
from ledgerlark.llm.decontaminate import contaminated
from ledgerlark.llm.line_dedup import dedup_lines
from ledgerlark.llm.mixing import mix_sources
from ledgerlark.llm.mixing import oracle as mixing_oracle
from ledgerlark.llm.near_dup import near_duplicates
from ledgerlark.llm.quality_rules import quality_scores
from ledgerlark.llm.substring_dedup import drop_repeated_spans
from ledgerlark.llm.suffix_dedup import drop_repeated_bytes
from ledgerlark.llm.toxicity import toxicity_scores
from ledgerlark.llm.warc import archive_round_trip
from ledgerlark.llm.whitening import whitened


def op1_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every embedding whose vec_id is divisible by 20."""
    rows = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return forest_search(rows, rows.where("id % 20 = 0"), k=20)


#: A conversation whose texts look like the template's own marks.
PROBE = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and the probe, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], rows.schema)
    return chat_digests(rows.unionByName(probe))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item it holds at least 80 % of, in five-word shingles."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=5, percent=80)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by the classifier trained on weak labels."""
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the runs of two lines or more that earlier documents hold."""
    return dedup_lines(table(spark, sf_dir, "documents"), runs=True)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words outside repeated 20-word windows of each document, as counts and a digest."""
    return (drop_repeated_spans(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by the rule ensemble."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, normalised and read back."""
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents at 0.8 Jaccard similarity of two-word shingle sets."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source temperature to the size of the corpus."""
    return mix_sources(table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes outside repeated 200-byte strings of each document, as counts and a digest."""
    return (drop_repeated_bytes(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with its cluster after ten rounds from eight start vectors."""
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first 32 whitened components."""
    return whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    from corpus_pipeline import run   # the module at the top of the repository

    return run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann_forest": op1_ann_forest,
    "op2_chat_format": op2_chat_format,
    "op3_decontamination": op3_decontamination,
    "op4_toxicity": op4_toxicity,
    "op5_line_dedup": op5_line_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_warc": op8_warc,
    "op9_near_dup": op9_near_dup,
    "op10_mixing": op10_mixing,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_centroids": op12_centroids,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}

#: Words as all operators take them, and five-word shingles of a table's texts.
_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

_OP3 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
     ds AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) AS t(i)),
     bs AS (SELECT DISTINCT item_id, array_to_string(w[i : i + 4], ' ') AS s FROM b, unnest(range(1, len(w) - 3)) AS t(i)),
     q AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT ds.doc_id, bs.item_id, count(*) AS n_common, any_value(q.n_item) AS n_item
FROM ds JOIN bs USING (s) JOIN q USING (item_id)
GROUP BY ds.doc_id, bs.item_id
HAVING 100 * count(*) >= 80 * any_value(q.n_item)
"""

#: Control strings of the chat template, longest first, and what stands for their first character.
_CONTROLS = [("<</SYS>>", "a"), ("<|other:", "a"), ("<<SYS>>", "a"), ("<|end|>", "a"), ("[/INST]", "b"), ("[INST]", "b"), ("</s>", "a"), ("<s>", "a"), ("|>", "c")]


def _escaped(text: str) -> str:
    sql = f"replace({text}, '\\', '\\\\')"
    for control, code in _CONTROLS:
        sql = f"replace({sql}, '{control}', '\\{code}{control[1:]}')"
    return sql


_OP2 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '{PROBE}'
  UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
),
s AS (
  SELECT *, row_number() OVER w AS place, coalesce(lag(role) OVER w, '') AS before, lead(role) OVER w IS NULL AS last
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
j AS (
  SELECT *, (before || '>' || role) IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')
            AND (NOT last OR role IN ('assistant', 'user')) AS fits,
         len({_escaped("text")}) + CASE role WHEN 'system' THEN len('<<SYS>>') + len('<</SYS>>') + 3 WHEN 'user' THEN len('[INST]') + len('[/INST]') + 2
           WHEN 'assistant' THEN len('<s>') + len('</s>') + 2 ELSE len('<|other:') + len({_escaped("role")}) + len('|>') + len('<|end|>') END AS size
  FROM s
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars, bool_and(fits) AS valid, min(CASE WHEN NOT fits THEN place END)::BIGINT AS error_turn
FROM j GROUP BY conv_id
"""

_OP8 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS digest FROM pages
),
g AS (SELECT digest, size, max(page_id) AS top FROM p WHERE size >= 1000 GROUP BY digest, size)
SELECT p.page_id, p.size::BIGINT AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN p.page_id < g.top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id < g.top THEN g.top END AS refers_to
FROM p LEFT JOIN g USING (digest, size)
"""

#: At this scale the search covers every row, so its result is the exact one.
_OP1 = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0) x
WHERE rank <= 20
"""

_OP6 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
     x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
     g AS (SELECT doc_id, p, string_agg(word, ' ') OVER f AS s, count(*) OVER f AS n FROM x
           WINDOW f AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
     r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS nth FROM g WHERE n = 20) y WHERE nth > 1),
     gone AS (SELECT DISTINCT doc_id, p + o AS p FROM r, range(0, 20) AS t(o)),
     k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM x ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

_OP9 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- A link shares 80 % of the larger set at least, so one of its rarest fifth (and one more) of shingles.
f AS (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY df, x) AS place FROM s JOIN (SELECT x, count(*) AS df FROM s GROUP BY x) USING (x)),
p AS (SELECT doc_id, x, n FROM f JOIN n USING (doc_id) WHERE place <= n - (4 * n + 4) // 5 + 1),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM p a JOIN p b ON a.x = b.x AND a.doc_id < b.doc_id
      WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
l AS (SELECT a, b FROM c JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b AND sb.x = sa.x
      GROUP BY a, b, na, nb HAVING 100 * count(*) >= 80 * (na + nb - count(*))),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT a AS doc_id, a AS other FROM e UNION SELECT r.doc_id, e.b FROM reach r JOIN e ON e.a = r.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(m, doc_id) AS component_id, coalesce(m, doc_id) = doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id) q USING (doc_id)
"""

_OP11 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(hex(encode(text)), '') AS h FROM documents),
     w AS (SELECT r, i, md5(substr(h, 2 * i - 1, 400)) AS m FROM d, unnest(range(1, len(h) // 2 - 198)) AS t(i)),
     g AS (SELECT r, i FROM w QUALIFY count(*) OVER (PARTITION BY m) > 1),
     n AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM g),
     s AS (SELECT r, min(i) AS a, max(i) + 199 AS b
           FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS island FROM n) x GROUP BY r, island),
     p AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM s),
     k AS (SELECT r, count(*) AS n_spans, sum(b - a + 1) AS gone, max(b) AS last,
                  string_agg(substr(h, 2 * before + 1, 2 * (a - 1 - before)), '' ORDER BY a) AS kept
           FROM p JOIN d USING (r) GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


def _op12(rounds: int = 10) -> str:
    """Ten rounds as a chain of statements: c<i> centroids, a<i> assignments."""
    def assigned(i):
        return f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, x, c AS cluster, d FROM (
    SELECT v.r, v.vec_id, v.x, k.c, list_sum(list_transform(list_zip(v.x, k.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d,
           row_number() OVER (PARTITION BY v.r ORDER BY list_sum(list_transform(list_zip(v.x, k.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), k.c) AS nth
    FROM v CROSS JOIN c{i} k) t WHERE nth = 1)"""

    def moved(i):
        return f"""m{i} AS (
  SELECT cluster, p, sum(e) AS total, count(*) AS n FROM (SELECT cluster, unnest(x) AS e, generate_subscripts(x, 1) AS p FROM a{i}) t GROUP BY cluster, p),
c{i + 1} AS MATERIALIZED (
  SELECT k.c, coalesce(n.x, k.x) AS x FROM c{i} k LEFT JOIN (
    SELECT cluster AS c, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY p) AS x FROM m{i} GROUP BY cluster) n USING (c))"""

    steps = ",\n".join(f"{assigned(i)},\n{moved(i)}" for i in range(rounds))
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding, list_transform(embedding::DOUBLE[], lambda e: floor(1024 * e)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR), embedding) - 1 AS c, x FROM v WHERE vec_id IS NOT NULL
  QUALIFY c < 8),
{steps},
{assigned(rounds)}
SELECT vec_id, cluster::INTEGER AS cluster, d::BIGINT AS distance, sum(d) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(k.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} k ON k.c = cluster
"""


ORACLES: dict[str, str] = {
    "op1_ann_forest": _OP1,
    "op2_chat_format": _OP2,
    "op3_decontamination": _OP3,
    "op6_substring_dedup": _OP6,
    "op8_warc": _OP8,
    "op9_near_dup": _OP9,
    "op10_mixing": mixing_oracle(),
    "op11_suffix_dedup": _OP11,
    "op12_centroids": _op12(),
}
