"""The operators as queries over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from tally.llm import language, periods, quality  # noqa: E402
from tally.llm.embeddings import near_vectors  # noqa: E402
from tally.llm.lines import without_later_lines  # noqa: E402
from tally.llm.minhash import Banding, near_duplicates  # noqa: E402
from tally.llm.negatives import hard_negatives  # noqa: E402
from tally.llm.packing import Sizes, best_fit  # noqa: E402
from tally.llm.pieces import Vocabulary, decoded, encoded  # noqa: E402
from tally.llm.sharding import shards  # noqa: E402
from tally.llm.substrings import without_repeats  # noqa: E402
from tally.llm.topk import top_k  # noqa: E402
from tally.llm.vectorpack import Limits, packed_documents  # noqa: E402

_SOUND_SQL = """embedding IS NOT NULL AND len(embedding) > 0 AND
    len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"""

_OP1_SQL = f"""
WITH RECURSIVE sound AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND {_SOUND_SQL}
),
units AS (SELECT *, sqrt(list_inner_product(v, v)) AS norm FROM sound WHERE list_inner_product(v, v) > 0),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM units a JOIN units b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.98
),
degrees AS (SELECT x, count(*) AS n FROM links GROUP BY 1),
reach AS (
    SELECT vec_id AS x, vec_id AS least FROM embeddings
    UNION
    SELECT l.y, r.least FROM reach r JOIN links l ON l.x = r.x
),
classes AS (SELECT x, min(least) AS component_id FROM reach GROUP BY 1)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN classes c ON c.x = e.vec_id LEFT JOIN degrees d ON d.x = e.vec_id
"""


@query("op1_embedding_near_dedup", _OP1_SQL)
def embedding_near_dedup(spark, d):
    return near_vectors(table(spark, d, "embeddings"), threshold=0.98)


_OP8_SQL = f"""
WITH whole AS (
    SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(64 * x)) AS v
    FROM embeddings WHERE {_SOUND_SQL}
),
scores AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM whole a JOIN whole b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 20 = 0
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query("op8_exact_top_k", _OP8_SQL)
def exact_top_k(spark, d):
    return top_k(table(spark, d, "embeddings"), "vec_id % 20 = 0", k=20, scale=64.0)


# Links are found between distinct shingle sets; a shingle that only one set has links nothing.
_OP10_SQL = r"""
WITH RECURSIVE words AS (
    SELECT rowid_ AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)
),
sets AS (
    SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1),
            lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s
    FROM words
),
nodes AS (SELECT s, md5(array_to_string(s, chr(10))) AS k, min(doc_id) AS least, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT k, n, unnest(s) AS g FROM nodes),
pairs AS (
    SELECT a.k AS x, b.k AS y, count(*) AS common, any_value(a.n) AS nx, any_value(b.n) AS ny
    FROM items a JOIN items b ON a.g = b.g AND a.k < b.k GROUP BY 1, 2
),
links AS (SELECT x, y FROM pairs WHERE 100 * common >= 85 * (nx + ny - common)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
    SELECT k, least FROM nodes
    UNION
    SELECT b.y, r.least FROM reach r JOIN both_ways b ON b.x = r.k
),
classes AS (SELECT k, min(least) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
       coalesce(c.component_id, s.doc_id) AS component_id, s.doc_id = coalesce(c.component_id, s.doc_id) AS kept
FROM sets s LEFT JOIN classes c ON len(s.s) > 0 AND c.k = md5(array_to_string(s.s, chr(10)))
"""


@query("op10_minhash_near_dedup", _OP10_SQL)
def minhash_near_dedup(spark, d):
    """Three-word shingles linked at 85 %; one row per document."""
    return near_duplicates(table(spark, d, "documents"), Banding(size=3, percent=85)).drop("row_key")


_OP7_SQL = r"""
WITH words AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
windows AS (
    SELECT r, list_transform(range(1, len(w) - 33), lambda p: md5(array_to_string(w[p : p + 34], ' '))) AS h
    FROM words WHERE len(w) >= 35
),
starts AS (SELECT r, unnest(h) AS h, generate_subscripts(h, 1) AS i FROM windows),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM starts) WHERE n > 1),
places AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
covered AS (
    SELECT p.r, p.i, p.word, coalesce(max(CASE WHEN s.i IS NOT NULL THEN 1 END)
        OVER (PARTITION BY p.r ORDER BY p.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
    FROM places p LEFT JOIN repeated s ON s.r = p.r AND s.i = p.i
),
kept AS (
    SELECT r, CAST(sum(gone) AS BIGINT) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept
    FROM covered GROUP BY 1
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (r)
"""


@query("op7_substring_dedup", _OP7_SQL)
def substring_dedup(spark, d):
    found = without_repeats(table(spark, d, "documents"), window=35)
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256")
    )


@query("op2_sharding")
def sharding(spark, d):
    return shards(table(spark, d, "documents"), 40)


# Of the places of a filled line the first one stays.
_OP9_SQL = r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS l FROM documents),
lines AS (SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM texts),
later AS (
    SELECT r, i FROM (
        SELECT r, i, row_number() OVER (PARTITION BY line ORDER BY doc_id NULLS FIRST, i) AS nth FROM lines
        WHERE regexp_matches(line, '[^\s]')
    ) WHERE nth > 1
),
marked AS (
    SELECT l.r, l.i, l.line, g.i IS NOT NULL AS out FROM lines l LEFT JOIN later g ON g.r = l.r AND g.i = l.i
),
kept AS (
    SELECT r, count(*) AS n_lines, count(*) FILTER (out) AS n_removed,
           string_agg(line, chr(10) ORDER BY i) FILTER (NOT out) AS kept_text
    FROM marked GROUP BY 1
)
SELECT t.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       CASE WHEN t.text IS NOT NULL THEN coalesce(k.kept_text, '') END AS kept_text
FROM texts t LEFT JOIN kept k USING (r)
"""


@query("op9_line_dedup", _OP9_SQL)
def line_dedup(spark, d):
    """Single lines count: the first place of each stays, whatever stands around the others."""
    return without_later_lines(table(spark, d, "documents"), gram=1, window=1)


def held_out(parts: int, part: int):
    """True for the documents whose hashed id falls into the part kept from training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(False))


@query("op5_language_id")
def language_id(spark, d):
    docs = table(spark, d, "documents")
    model = language.fit(docs, ~held_out(3, 1))
    return language.predicted(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


@query("op6_quality_classifier")
def quality_classifier(spark, d):
    docs = table(spark, d, "documents")
    model = quality.fit(docs, table(spark, d, "labels"), ~held_out(4, 2))
    return quality.scored(docs, model).select(
        "doc_id", held_out(4, 2).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query("op3_sentencepiece")
def sentencepiece(spark, d, model: str = PIECES):
    """Ids of every text, and a checksum of the text that they decode to."""
    vocabulary = Vocabulary.load(model)
    restored = decoded(encoded(table(spark, d, "documents"), vocabulary), vocabulary)
    return restored.select(
        "doc_id", F.when(F.col("ids").isNotNull(), F.size("ids")).cast("bigint").alias("n_tokens"), "ids",
        F.crc32("text").alias("decoded_crc32"),
    )


@query("op4_best_fit_packing")
def best_fit_packing(spark, d):
    return best_fit(table(spark, d, "documents"), Sizes())


# crc32 bit by bit; words that stand q places apart and agree, in stretches without gaps, for every q.
_OP12_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda x, c: list_reduce(list_prepend(xor(x, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384::BIGINT) ELSE y // 2 END)
        ), 4294967295::BIGINT) AS h
    FROM documents
),
planned AS (
    SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM texts
),
words AS (
    SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i:
        w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS w
    FROM planned
),
places AS (SELECT r, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM words),
pairs AS (
    SELECT x.r, x.i, y.i - x.i AS lag FROM places x JOIN places y
    ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
islands AS (SELECT r, lag, i, i - row_number() OVER (PARTITION BY r, lag ORDER BY i) AS island FROM pairs),
stretches AS (
    SELECT r, min(i) AS start, count(*) + lag AS length, lag FROM islands GROUP BY r, lag, island
    HAVING count(*) + lag >= greatest(6, 4 * lag)
),
runs AS (SELECT r, start, length, min(lag) AS period FROM stretches GROUP BY 1, 2, 3),
best AS (
    SELECT * FROM (SELECT x.*, row_number() OVER (PARTITION BY r ORDER BY
        length::DECIMAL(38, 0) * 1000000000000000 // period DESC, start, period) AS nth FROM runs x) WHERE nth = 1
),
listed AS (
    SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS s
    FROM runs GROUP BY 1
),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
    SELECT p.r, string_agg(p.word, ' ' ORDER BY p.i) AS t
    FROM places p LEFT JOIN gone g ON g.r = p.r AND g.i = p.i WHERE g.i IS NULL GROUP BY 1
)
SELECT w.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length,
    b.period::BIGINT AS period, (1000 * b.length // b.period)::BIGINT AS exponent_milli,
    sha256(coalesce(l.s, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM words w LEFT JOIN listed l USING (r) LEFT JOIN best b USING (r) LEFT JOIN kept k USING (r)
"""


@query("op12_periodic_runs", _OP12_SQL)
def periodic_runs(spark, d):
    """Runs of whole texts, a tenth of which are made to repeat first."""
    return periods.digests(periods.periodic_runs(periods.looped(table(spark, d, "documents"))))


@query("op13_vector_packing")
def vector_packing(spark, d, tokenizer: str | None = None):
    """All tokens of all texts bear loss; a sequence mixes 256 pieces at most."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    limits = Limits(tokens=2048, segments=256, loss=2048)
    placed = packed_documents(table(spark, d, "documents"), tokenizer, limits, with_ids=False)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


_OP11_SQL = f"""
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
    FROM embeddings WHERE label IS NOT NULL AND {_SOUND_SQL}
),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM whole a JOIN whole b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth FROM scores WHERE same
    ) WHERE nth <= 5
),
mined AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
           n.score AS negative_score, CAST(row_number() OVER (
               PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
    FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
    WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM mined WHERE rank <= 5
"""


@query("op11_hard_negatives", _OP11_SQL)
def hard_negative_mining(spark, d):
    """Labels of every seventh vector move on by one before mining."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, d, "embeddings").withColumn("label", moved), "vec_id % 100 = 0")
