"""One query for each operator, on the test tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    contamination,
    jaccard,
    neighbours,
    packing,
    periodic,
    phrases,
    records,
    sharding,
    substrings,
    toxicity,
    urls,
    verified_copies,
    warc,
)
from clickloom.session import shared_dir

TOKENIZER = "byte_bpe_50k.json"
RECORD_END, SEQUENCE_END, SEQUENCE_SIZE = 2, 0, 2048
SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, written and read back by byte ranges."""
    folder = shared_dir(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    found = warc.read_warc(spark, folder, payloads=False).filter(F.col("record_type").isin("response", "revisit"))
    row = lambda name: F.regexp_extract(name, "^<urn:row:(-?[0-9]+)>$", 1).try_cast("long")
    return found.select(
        row("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", row("refers_to").alias("refers_to")
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their toxicity."""
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model, keep=["doc_id"])
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their group of near copies and their number of links."""
    linked = jaccard.linked_documents(jaccard.similarity_join(table(spark, sf_dir, "documents")))
    return linked.select(F.col("key").alias("doc_id"), F.col("group").alias("class_id"), F.col("links").alias("n_links"))


RULES = [
    urls.Rule("org", "/", True),
    urls.Rule("example.org", "/es/", False),
    urls.Rule("example.org", "/en/1", False),
    urls.Rule("com", "/fr/", True),
    urls.Rule("com", "/de/", False),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages with the verdict on their URL."""
    judged = urls.judge(table(spark, sf_dir, "pages"), RULES)
    return judged.select(F.col("key").alias("page_id"), "host", "path", "rule", "verdict")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the windows of 13 words that earlier documents have."""
    kept = substrings.remove_repeated(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return kept.select(F.col("key").alias("doc_id"), "n_words", "n_removed", digest)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that contain items of the benchmark, with the items."""
    found = contamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "shared", "total", "containment")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as framed records, written and read back."""
    documents = table(spark, sf_dir, "documents")
    manifest = records.write_tokens(
        documents, shared_dir(spark, "records"), public_tokenizers.path(TOKENIZER), RECORD_END
    )
    back = records.read_tokens(spark, manifest)
    return back.select(F.col("key").alias("doc_id"), "start", "n_tokens", records.ids_crc32(F.col("ids")).alias("ids_crc32"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences."""
    packed = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), SEQUENCE_END, SEQUENCE_SIZE
    )
    crc = F.crc32("ids").alias("ids_crc32")
    return packed.select(F.col("key").alias("doc_id"), "piece", "start", "length", crc, "sequence_id", "offset")


def op10_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards that match the mixture of sources."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", size.alias("size"), crc.alias("text_crc32"))
    placed = sharding.interleave(rows, SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their component of near copies."""
    found = verified_copies.near_copies(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, some with a planted periodic end, with their runs."""
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), planted=True)
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run.start, run.length, run.period), F.lit("\n")))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    best = [F.col(f"strongest.{name}").alias(name) for name in ("start", "length", "period")]
    exponent = F.expr("1000L * strongest.length div strongest.period").alias("exponent_milli")
    runs, collapsed = digest(F.array_join(lines, "")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256")
    return found.select(F.col("key").alias("doc_id"), "n_runs", *best, exponent, runs, collapsed)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_toxicity": op2_toxicity,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_url_filter": op4_url_filter,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_token_records": op8_token_records,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_stratified_shards": op10_stratified_shards,
    "op11_near_copies": op11_near_copies,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
}

# Words as in the operator: no ASCII white space inside.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Words of shingles: ASCII letters, digits and characters beyond ASCII, in lower case.
SHINGLE_WORD = r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"

def _url_model_sql(order: int = 5, alphabet: int = 256) -> str:
    """The verdicts on URLs: rules, Witten-Bell models of all orders, scores, threshold."""
    by_length = sorted(RULES, key=lambda rule: -len(rule.name))
    fits = {r.name: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in by_length}
    rule = " ".join(f"WHEN {fits[r.name]} THEN '{r.name}'" for r in by_length)
    allow = " ".join(f"WHEN rule = '{r.name}' THEN {str(r.allow).upper()}" for r in by_length)
    levels = [f"p0 AS (SELECT '' AS gram, {1.0 / alphabet}::DOUBLE AS pa, {1.0 / alphabet}::DOUBLE AS pb)"]
    for k in range(1, order + 1):
        mixed = ", ".join(
            f"CASE WHEN {x}_all > 0 THEN ({x} + {x}_kinds * p{x}) / ({x}_all + {x}_kinds) ELSE p{x} END AS p{x}" for x in "ab"
        )
        sums = ", ".join(f"sum({x}) OVER c AS {x}_all, sum(({x} > 0)::DOUBLE) OVER c AS {x}_kinds" for x in "ab")
        levels.append(
            f"g{k} AS (SELECT right(gram, {k}) AS gram, sum(a)::DOUBLE AS a, sum(b)::DOUBLE AS b FROM counts GROUP BY 1)"
        )
        levels.append(f"w{k} AS (SELECT *, {sums} FROM g{k} WINDOW c AS (PARTITION BY left(gram, {k - 1})))")
        levels.append(f"p{k} AS (SELECT w.gram, {mixed} FROM w{k} w JOIN p{k - 1} q ON q.gram = right(w.gram, {k - 1}))")
    return f"""
        WITH texts AS (SELECT coalesce(url, '') AS url, count(*) AS pages FROM pages GROUP BY 1),
        parsed AS (
            SELECT url, pages, substr(md5(url), 1, 1) IN ('0', '1', '2') AS calibrates,
                translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}') AS host,
                regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
            FROM texts
        ),
        ruled AS (SELECT *, CASE {rule} END AS rule FROM parsed),
        labelled AS (SELECT *, CASE {allow} END AS allow FROM ruled),
        grams AS (
            SELECT url, pages, allow, calibrates, substr(repeat(chr(2), {order - 1}) || url, place, {order}) AS gram
            FROM (SELECT *, unnest(range(1, length(url) + 1)) AS place FROM labelled)
        ),
        counts AS (
            SELECT gram, coalesce(sum(pages) FILTER (allow AND NOT calibrates), 0) AS a,
                coalesce(sum(pages) FILTER (NOT allow AND NOT calibrates), 0) AS b
            FROM grams GROUP BY gram
        ),
        {", ".join(levels)},
        sums AS (SELECT url, sum(ln(pa) - ln(pb)) AS ratio FROM grams JOIN p{order} USING (gram) GROUP BY url),
        scored AS (
            SELECT l.*, CASE WHEN length(url) > 0 THEN round(ratio / length(url), 9) ELSE 0 END AS score
            FROM labelled l LEFT JOIN sums USING (url)
        ),
        steps AS (
            SELECT floor(score * {urls.Settings().steps})::BIGINT AS step, coalesce(sum(pages) FILTER (allow), 0) AS a,
                coalesce(sum(pages) FILTER (NOT allow), 0) AS b
            FROM scored WHERE allow IS NOT NULL AND calibrates AND length(url) > 0 GROUP BY 1
        ),
        edges AS (
            SELECT *, coalesce(sum(a) OVER (ORDER BY step ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS over,
                coalesce(sum(b) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS under,
                coalesce(lag(step) OVER (ORDER BY step) + 1, step) AS low
            FROM (SELECT * FROM steps UNION ALL SELECT max(step) + 1, 0, 0 FROM steps)
        ),
        best AS (
            SELECT least(greatest(0, low), step) AS step, over * (SELECT sum(b) FROM steps) + under * (SELECT sum(a) FROM steps) AS gain
            FROM edges
        ),
        threshold AS (
            SELECT CASE WHEN (SELECT sum(a) > 0 AND sum(b) > 0 FROM steps)
                THEN (SELECT step FROM best ORDER BY gain DESC, abs(step), step LIMIT 1) / {urls.Settings().steps}.0 ELSE 0 END AS least
        )
        SELECT page_id, host, path, rule, CASE WHEN coalesce(allow, score >= least) THEN 'allow' ELSE 'block' END AS verdict
        FROM pages JOIN scored ON scored.url = coalesce(pages.url, ''), threshold
    """


# A to Z in lower case, as bytes.
LOWERED = f"translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}')"

ORACLE: dict[str, str] = {
    "op11_near_copies": rf"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS words FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, list_slice(words, place, place + 3) AS part FROM (
                SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 2))) AS place FROM split WHERE len(words) > 0
            )
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
            FROM shingles x JOIN shingles y ON x.part = y.part AND x.doc_id <> y.doc_id GROUP BY 1, 2
        ),
        links AS (
            SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)
        ),
        reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
        lowest AS (SELECT a, min(b) AS low FROM reached GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
            doc_id <= coalesce(low, doc_id) AS kept
        FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON lowest.a = doc_id
    """,
    "op12_collocations": rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all({LOWERED}, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents
        ),
        split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
        grams AS (
            SELECT lang, size, unnest([list_slice(words, i, i + size - 1) for i in range(1, len(words) - size + 2)]) AS gram
            FROM split, (SELECT unnest([1, 2, 3]) AS size)
        ),
        f AS (SELECT lang, size, gram, count(*) AS f FROM grams GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
        candidates AS (SELECT * FROM f WHERE size > 1 AND f >= 10),
        cuts AS (
            SELECT c.lang, c.gram, c.f AS a, k, x.f AS l, y.f AS r,
                (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
            FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
            JOIN f x ON x.lang = c.lang AND x.gram = list_slice(c.gram, 1, k)
            JOIN f y ON y.lang = c.lang AND y.gram = list_slice(c.gram, k + 1, c.size)
        ),
        worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
        inside AS (
            SELECT DISTINCT s.lang, s.gram FROM candidates s
            JOIN (SELECT lang, f, unnest([list_slice(gram, 1, 2), list_slice(gram, 2, 3)]) AS gram FROM candidates WHERE size = 3) b
            ON b.lang = s.lang AND b.gram = s.gram AND 100 * b.f >= 50 * s.f
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
            FROM (SELECT lang, array_to_string(gram, ' ') AS phrase, a, l, r, score FROM worst ANTI JOIN inside USING (lang, gram))
        )
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
    "op4_url_filter": _url_model_sql(),
    "op1_warc": """
        WITH sized AS (
            SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
            FROM pages
        ),
        tops AS (SELECT html, max(page_id) AS top FROM sized WHERE payload_bytes >= 1000 GROUP BY html)
        SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
            CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id < top THEN top END AS refers_to
        FROM sized LEFT JOIN tops USING (html)
    """,
    "op3_jaccard_join": f"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{SHINGLE_WORD}') AS words FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, list_slice(words, place, place + 4) AS part FROM (
                SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS place FROM split WHERE len(words) > 0
            )
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
            FROM shingles x JOIN shingles y ON x.part = y.part AND x.doc_id <> y.doc_id GROUP BY 1, 2
        ),
        links AS (
            SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE s.n * 5 >= (x.n + y.n - s.n) * 4
        ),
        reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
        lowest AS (SELECT a, min(b) AS low FROM reached GROUP BY a),
        degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT doc_id, least(doc_id, coalesce(low, doc_id)) AS class_id, coalesce(degree.n, 0) AS n_links
        FROM documents LEFT JOIN lowest ON lowest.a = doc_id LEFT JOIN degree ON degree.a = doc_id
    """,
    "op5_substring_dedup": f"""
        WITH split AS (SELECT doc_id, {WORDS} AS words FROM documents),
        windows AS (
            SELECT doc_id, place, list_slice(words, place, place + 12) AS part
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS place FROM split)
        ),
        firsts AS (SELECT part, min(doc_id) AS first_id FROM windows GROUP BY part HAVING count(*) > 1),
        lost AS (
            SELECT DISTINCT doc_id, unnest(range(place, place + 13)) AS place
            FROM windows JOIN firsts USING (part) WHERE first_id < doc_id
        ),
        gone AS (SELECT doc_id, list(place) AS places, count(*) AS n FROM lost GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed,
            sha256(coalesce(array_to_string(
                CASE WHEN n IS NULL THEN words
                ELSE list_filter(words, lambda w, i: NOT list_contains(places, i)) END, ' '), '')) AS kept_sha256
        FROM split LEFT JOIN gone USING (doc_id)
    """,
    "op6_decontamination": f"""
        WITH texts AS (
            SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
        ),
        split AS (
            SELECT kind, id, regexp_extract_all(lower(coalesce(text, '')), '{SHINGLE_WORD}') AS words FROM texts
        ),
        shingles AS (
            SELECT DISTINCT kind, id, list_slice(words, place, place + 4) AS part FROM (
                SELECT kind, id, words, unnest(range(1, greatest(2, len(words) - 3))) AS place
                FROM split WHERE len(words) > 0
            )
        ),
        totals AS (SELECT id, count(*) AS total FROM shingles WHERE kind = 'i' GROUP BY id),
        shared AS (
            SELECT d.id AS doc_id, i.id AS item_id, CAST(count(*) AS INTEGER) AS shared
            FROM shingles d JOIN shingles i ON d.part = i.part AND d.kind = 'd' AND i.kind = 'i' GROUP BY 1, 2
        )
        SELECT doc_id, item_id, shared, CAST(total AS INTEGER) AS total, shared / total AS containment
        FROM shared JOIN totals ON id = item_id WHERE shared * 5 >= total * 4
    """,
    # The table of the checksum follows from its polynomial, bit by bit.
    "op10_stratified_shards": f"""
        WITH RECURSIVE bits AS (
            SELECT n, n AS c, 0 AS step FROM (SELECT unnest(range(0, 256)) AS n)
            UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8
        ),
        crc AS (SELECT list(c ORDER BY n) AS rest FROM bits WHERE step = 8),
        sized AS (
            SELECT doc_id, source, strlen(coalesce(text, '')) + 16 AS size, xor(4294967295, list_reduce(
                list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: ('0x' || b)::BIGINT),
                lambda c, b: xor(c >> 8, rest[xor(c & 255, b) + 1]), 4294967295)) AS text_crc32
            FROM documents, crc
        ),
        ranked AS (
            SELECT *, (row_number() OVER (PARTITION BY source ORDER BY md5('0:' || coalesce(doc_id::VARCHAR, '')), size, text_crc32) - 0.5)::DOUBLE
                / count(*) OVER (PARTITION BY source) AS fraction
            FROM sized
        ),
        placed AS (
            SELECT *, row_number() OVER (ORDER BY fraction, source NULLS FIRST, doc_id, size, text_crc32) - 1 AS position,
                count(*) OVER () // {SHARDS} AS least, count(*) OVER () % {SHARDS} AS larger
            FROM ranked
        ),
        sharded AS (
            SELECT *, CASE WHEN position < larger * (least + 1) THEN position // (least + 1)
                ELSE larger + (position - larger * (least + 1)) // greatest(least, 1) END AS shard
            FROM placed
        )
        SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
            (position - (shard * least + least(shard, larger)))::BIGINT AS slot, NULL::INTEGER AS grown_shard
        FROM sharded
    """,
}
