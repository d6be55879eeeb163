"""The operators' queries over the given tables, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.llm import align, annsearch, decontam, htmlcut, lengths, mixing, neardup, ordinal, runs, sharding, tokenbin, toxicity, warc


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: words hit by benchmark windows, and the items they come from."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.with_hits(decontam.find_leaks(docs, read(spark, sf_dir, "benchmark")))
    return found.select(
        "doc_id", F.col("leak_n_words").alias("n_words"), F.col("leak_n_hit").alias("n_hit"),
        F.size("leak_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("leak_items")), 256).alias("items_sha256"),
        (F.col("leak_n_hit") > 0).alias("contaminated"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = htmlcut.extract(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.col("main_chars").alias("n_chars"), "main_blocks", "page_blocks")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each context limit that is some document's length: tokens kept and cut there."""
    docs = read(spark, sf_dir, "documents").select("text")
    return lengths.at_every_limit(lengths.histogram(lengths.token_counts(docs, tokenizer_path())))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: how likely its label is toxic."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = lambda c: F.coalesce(F.crc32(F.col(c).cast("string")) % 4 == 2, F.lit(True))
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), F.col("toxic"), allowed=~held("id"))
    return toxicity.score(docs, model).select("doc_id", held("doc_id").alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.3).cast("int").alias("predicted"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for each vector whose id is divisible by 20."""
    vectors = read(spark, sf_dir, "embeddings")
    found = annsearch.search(vectors, vectors.where("vec_id % 20 = 0"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, from the files read back: where its ids start, how many, and their checksum."""
    found = tokenbin.encode_and_read_back(read(spark, sf_dir, "documents"), tokenizer_path())
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its size and the words that the mix takes of it."""
    return mixing.taken(read(spark, sf_dir, "documents"), key=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page, from the archives read back."""
    found = warc.write_and_read_back(read(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its component of documents with a Jaccard similarity of 0.75 or more."""
    found = neardup.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                        (F.col("id") == F.col("component")).alias("kept"))


def op10_ordinal_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: expected grade, tail probabilities, and whether it is kept."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = ordinal.train(docs, ordinal.rated(read(spark, sf_dir, "labels")), ordinal.label_grade(), ordinal.LEVELS)
    found = ordinal.score(docs.select("doc_id", "text"), model)
    tail = F.col("tail_probability")
    return found.select("doc_id", "expected_grade", tail[0].alias("p_grade_1"), tail[1].alias("p_grade_2"), (tail[0] >= 0.5).alias("kept"))


def op11_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: how its ids by two tokenizers line up, and how usual its linked pairs are in the corpus."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = align.Alignment(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model")).result()
    return found.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups")


def op12_interleave_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its shard of 16 and its place there; every shard has the sources' mixture."""
    text = F.coalesce("text", F.lit(""))
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    found = sharding.interleave(docs, ["doc_id", "size", "text_crc32"])
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def replayed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the words of every tenth document, by the crc32 of its id, played again from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def again(w):
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        words = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(words, " ")).otherwise("")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return docs.select("doc_id", F.when(h % 10 == 0, F.transform(F.array(words), again)[0]).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its runs, the longest of them, and the text without their repeats."""
    found = runs.with_runs(replayed(read(spark, sf_dir, "documents")))
    best = found.withColumn("best", F.expr("array_max(transform(runs, r -> named_struct('length', r.length, 'start', -r.start, 'period', -r.period)))"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {q.__name__: q for q in (op1_decontaminate, op2_main_text, op3_token_counts, op4_toxicity, op5_nearest, op6_token_files, op7_mix_sources, op8_warc, op9_near_duplicates, op10_ordinal_grades, op11_align_tokenizers, op12_interleave_shards, op13_periodic_runs)}
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN win ON dw.n = win.n AND dw.k = win.k),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)] AS weight, 2 * source_size AS cap, sum(source_size) OVER () * 1.5 AS total FROM s),
l AS (SELECT w.*, lo.level FROM w, (SELECT max(CASE WHEN (total - f) / o <= cap / weight THEN (total - f) / o END) AS level
        FROM (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS f,
                     sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS o FROM w)) lo),
g AS (SELECT source, source_size, least(cap, coalesce(level * weight, cap))::DOUBLE AS target FROM l),
line AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('line/' || doc_id), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM d)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(a + size, round(target)) - a) + greatest(0, least(a + size, round(target) - source_size) - a))::BIGINT AS taken
FROM line JOIN g ON line.source IS NOT DISTINCT FROM g.source"""

OP8_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, h, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS hex, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, (k // 8)::BIGINT * 10 + 1, 10))::BIGINT >> (35 - 5 * (k % 8))::INTEGER) & 31)::BIGINT, 1) FOR k IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM x"""

OP9_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM sh GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = d.doc_id"""

_HALF = "xor({c} >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][1 + (xor({c}, {x}) & 15)])"
_BYTE = _HALF.format(c="(" + _HALF.format(c="c", x="x") + ")", x="(x >> 4)")
#: crc32 of a text, half a byte at a time. The polynomial's table of half bytes.
CRC32 = f"""xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({{}})), '..'), lambda h: ('0x' || h)::BIGINT)), lambda c, x: {_BYTE}))"""
OP12_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS g FROM documents),
s AS (SELECT doc_id, g, strlen(t)::BIGINT + 1 AS size, {crc}::BIGINT AS text_crc32 FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY md5('shard/' || coalesce(doc_id::VARCHAR, '') || '/' || size || '/' || text_crc32)) - 1 AS rank, count(*) OVER (PARTITION BY g) AS n FROM s),
k AS (SELECT g, (row_number() OVER (ORDER BY n, g) - 1)::DOUBLE * 0.6180339887498949::DOUBLE AS x FROM (SELECT DISTINCT g, n FROM r)),
p AS (SELECT *, row_number() OVER (ORDER BY (rank + (x - floor(x))) / n, g, rank) - 1 AS pos, count(*) OVER () AS total FROM r JOIN k USING (g))
SELECT doc_id, size, text_crc32, 'rows' AS law, (pos * 16 // total)::INTEGER AS shard,
       (pos - ((pos * 16 // total) * total + 15) // 16)::BIGINT AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p""".replace("{crc}", CRC32.format("t"))

OP13_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {crc} AS h FROM (SELECT *, doc_id::VARCHAR AS s FROM documents)),
p AS (SELECT doc_id, w, h, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a FROM d),
tok AS (SELECT doc_id, unnest(w) AS v, unnest(range(len(w))) AS i FROM p),
pos AS (SELECT doc_id, n, i, CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END AS src FROM (SELECT *, unnest(range(n)) AS i FROM p)),
t AS (SELECT pos.doc_id, pos.i, pos.n, tok.v FROM pos JOIN tok ON tok.doc_id = pos.doc_id AND tok.i = pos.src),
m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.v = y.v AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isl AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS grp FROM m),
run AS (SELECT doc_id, s, l, min(q) AS q FROM (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM isl GROUP BY doc_id, q, grp) WHERE l >= greatest(6, 4 * q) GROUP BY doc_id, s, l),
out AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM run),
kept AS (SELECT t.doc_id, string_agg(v, ' ' ORDER BY t.i) AS c FROM t ANTI JOIN out ON out.doc_id = t.doc_id AND out.i = t.i GROUP BY t.doc_id),
agg AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS r, min(struct_pack(a := -l, b := s, c := q)) AS best FROM run GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.b::BIGINT AS start, (-best.a)::BIGINT AS length, best.c::BIGINT AS period,
       (1000 * -best.a // best.c)::BIGINT AS exponent_milli, sha256(coalesce(r, '')) AS runs_sha256, sha256(coalesce(kept.c, '')) AS collapsed_sha256
FROM d LEFT JOIN agg USING (doc_id) LEFT JOIN kept USING (doc_id)""".replace("{crc}", CRC32.format("s"))

ORACLES: dict[str, str] = {"op1_decontaminate": OP1_SQL, "op7_mix_sources": OP7_SQL, "op8_warc": OP8_SQL, "op9_near_duplicates": OP9_SQL, "op12_interleave_shards": OP12_SQL, "op13_periodic_runs": OP13_SQL}
