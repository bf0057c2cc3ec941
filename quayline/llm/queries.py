"""One query per operator over its whole table.  ``QUERIES`` and ``ORACLES`` go to the driver."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayline.llm.bottomk import edited_fingerprints
from quayline.llm.common import ORACLES, QUERIES, WORD, in_training, query, table
from quayline.llm.edits import count_edits, read_ranks
from quayline.llm.idfiles import id_file_documents, read_tokenizer
from quayline.llm.language import predict_language, train_language
from quayline.llm.minmax import near_duplicates
from quayline.llm.mixing import mix_sources
from quayline.llm.naming import exact_duplicates
from quayline.llm.pieces import encoding_digests, read_model
from quayline.llm.pivots import top_products
from quayline.llm.runs import greatest_run, periodic_runs
from quayline.llm.secretscan import (
    ACCESS,
    ALPHABETS,
    ASSIGN,
    ASSIGN_LEAST,
    BINS_PER_DECADE,
    CHANGES,
    CLASSES,
    COINCIDENCE,
    CORRELATION,
    FALSE_DISCOVERIES,
    HEX,
    KINDS,
    LAST_BIN,
    MARKS,
    TOKEN,
    WIDEST,
    scan_secrets,
    written_spans,
)
from quayline.llm.toxicity import score_toxicity, train_toxicity
from quayline.llm.tries import continued, conversations, prefix_trie

__all__ = ["ORACLES", "QUERIES"]


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return score_toxicity(docs, train_toxicity(docs, labels, in_training()))


@query("op2_id_files")
def op2_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return id_file_documents(table(spark, sf_dir, "documents"), tokenizer, end_id=1)


@query("op4_pieces")
def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return encoding_digests(table(spark, sf_dir, "documents"), model, end_id=2)


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict_language(docs, train_language(docs, in_training()))


@query(
    "op9_mixing",
    r"""WITH sized AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint AS size
      FROM documents), sources AS (
      SELECT source, sum(size)::bigint AS source_size,
        [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::double AS weight
      FROM sized GROUP BY source), ranked AS (
      SELECT *, 2.0::double * source_size AS bound, row_number() OVER (
          ORDER BY 2.0::double * source_size / weight, source NULLS LAST) AS k,
        least(1.5::double * sum(source_size) OVER (), 2.0::double * sum(source_size) OVER ()) AS total,
        sum(weight) OVER () AS weights
      FROM sources), levels AS (
      SELECT *, (total - coalesce(sum(bound) OVER before, 0))
        / (weights - coalesce(sum(weight) OVER before, 0)) AS level
      FROM ranked WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
      final AS (SELECT min_by(level, k) FILTER (WHERE bound > level * weight) AS level FROM levels),
      targets AS (
      SELECT source, source_size, least(bound, coalesce(f.level, 1e308) * weight) AS target
      FROM ranked, final f), lines AS (
      SELECT doc_id, size, source_size, target, floor(target)::bigint AS quota, greatest(source_size, 1) AS words,
        coalesce(sum(size) OVER (PARTITION BY s.source
          ORDER BY md5('17:' || coalesce(doc_id::varchar, '') || ':' || size), doc_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS low
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
      (size * (quota // words + (2 * low + size < 2 * (quota % words))::int))::bigint AS taken
    FROM lines""",
)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _sketch_sql(text: str) -> str:
    """The bottom-k sketch of a text in DuckDB."""
    words = (
        f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        r"'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
    )
    return f"""list_sort(list_distinct(list_transform([{words}], lambda w:
      CASE WHEN len(w) = 0 THEN []::varchar[] ELSE list_transform(range(1, greatest(len(w) - 3, 2)),
      lambda i: md5(array_to_string(w[i:i + 4], ' '))[1:12]) END)[1]))[1:64]"""


def _alike_sql(a: str, b: str) -> str:
    union = f"list_sort(list_distinct(list_concat({a}, {b})))[1:64]"
    return f"""CASE WHEN len({union}) = 0 THEN 1.0::double ELSE
      len(list_intersect(list_intersect({a}, {b}), {union}))::double / len({union}) END"""


def _distinct_sql(a: str) -> str:
    return f"""CASE WHEN len({a}) < 64 THEN len({a})::double ELSE 63::double * {16**12}::double
      / greatest(('0x' || {a}[-1])::bigint::double, 1::double) END"""


@query(
    "op10_bottomk",
    f"""WITH texts AS (
      SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::bigint AS n
      FROM documents), followed AS (
      SELECT *, lead(text) OVER (ORDER BY doc_id NULLS FIRST) AS coming,
        first_value(text) OVER (ORDER BY doc_id NULLS FIRST) AS first_text
      FROM texts), pairs AS (
      SELECT doc_id, n, text, coalesce(coming, first_text) AS next_text,
        left(text, n - n // 4) || left(coalesce(coming, first_text), n // 4) AS edited
      FROM followed), drawn AS (
      SELECT doc_id, n, edited, {_sketch_sql("text")} AS a, {_sketch_sql("edited")} AS b,
        {_sketch_sql("next_text")} AS c
      FROM pairs), measured AS (
      SELECT *, {_alike_sql("a", "b")} AS near_edited, {_alike_sql("a", "c")} AS near_next,
        {_distinct_sql("a")} AS n_shingles, {_distinct_sql("b")} AS n_edited
      FROM drawn)
    SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256,
      coalesce(array_to_string(a, ''), '') AS fingerprint,
      coalesce(array_to_string(b, ''), '') AS edited_fingerprint,
      near_edited, near_next, CASE WHEN len(a) = 0 THEN 1::double ELSE least(1::double,
        near_edited / (1 + near_edited) * (n_shingles + n_edited) / n_shingles) END AS kept_share,
      n_shingles
    FROM measured""",
)
def op10_bottomk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def _located_sql(pattern: str, kind: int, least: int = 0, group: int = 0) -> str:
    """Matches as structs of start, kind, end and value, by the lengths of what lies between them."""
    return f"""list_filter(list_transform([{{
        'm': regexp_extract_all(text, '{pattern}'), 'g': string_split_regex(text, '{pattern}'),
        'v': regexp_extract_all(text, '{pattern}', {group})}}], lambda f:
      list_transform(range(1, len(f.m) + 1), lambda i: {{
        'start': coalesce(list_sum(list_transform(f.g[1:i], lambda t: length(t))), 0)::int
          + coalesce(list_sum(list_transform(f.m[1:i - 1], lambda t: length(t))), 0)::int,
        'kind': {kind}, 'size': length(f.m[i]), 'value': f.v[i]}}))[1],
      lambda s: length(s.value) >= {least})"""


def _written_sql(spans: str) -> str:
    return f"""coalesce(array_to_string(list_transform({spans}, lambda s:
      {list(KINDS)}[s.kind + 1] || ':' || s.start || ':' || (s.start + s.size)), ','), '')"""


def _secrets_sql() -> str:
    assign = ASSIGN.replace("'", "''")
    alphabets = " ".join(
        f"WHEN regexp_matches(token, '{pattern}') THEN '{symbols}'" for pattern, symbols in ALPHABETS
    )
    classes = " + ".join(f"(length(value) >= {c})::int" for c in CLASSES[1:])
    spans = "list_transform({}, lambda s: {{'start': s.start, 'kind': s.kind, 'size': s.size}})"
    return rf"""WITH texts AS (
      SELECT doc_id, coalesce(text, '') AS text FROM documents), found AS (
      SELECT doc_id, list_sort(list_concat({spans.format(_located_sql(assign, 0, ASSIGN_LEAST, 2))},
          {spans.format(_located_sql(ACCESS, 1))}, {spans.format(_located_sql(HEX, 2))})) AS base,
        {_located_sql(TOKEN, 3)} AS tokens
      FROM texts), tokens AS (
      SELECT DISTINCT unnest(tokens).value AS token FROM found), bodies AS (
      SELECT token, translate(rtrim(translate(token, '=', ' ')), '-_ ', '+/') AS body,
        CASE {alphabets} ELSE '{WIDEST}' END AS symbols
      FROM tokens), measured AS (
      SELECT token, body, symbols, length(body)::double AS n, length(symbols)::double AS size,
        list_sum(list_transform(string_split(symbols, ''), lambda c:
          pow((length(body) - length(replace(body, c, '')))::double, 2))) AS squares,
        list_transform(string_split(body, ''), lambda c: instr(symbols, c)::double) AS v,
        translate(body, '{string.ascii_lowercase + string.ascii_uppercase + string.digits + MARKS}',
          '{"a" * 26 + "A" * 26 + "0" * 10 + "+" * len(MARKS)}') AS kinds
      FROM bodies), moments AS (
      SELECT *, list_sum(v) / n AS mid,
        list_sum(list_transform(range(1, len(kinds)),
          lambda i: (kinds[i] <> kinds[i + 1])::int)) AS changes,
        greatest({COINCIDENCE}, 1.5 / size) AS alike
      FROM measured), tests AS (
      SELECT token, n, (size * (1 + (n - 1) * alike) - n - (size / n * squares - n))
          / sqrt(2 * (size - 1) + 4 * n * (size * alike - 1)) AS z1,
        (changes - (n - 1) * {CHANGES}) / sqrt((n - 1) * {CHANGES} * (1 - {CHANGES})) AS z2,
        list_sum(list_transform(v, lambda x: x * x)) - n * mid * mid AS square,
        list_sum(list_transform(range(1, len(v)), lambda i: (v[i] - mid) * (v[i + 1] - mid))) AS steps
      FROM moments), combined AS (
      SELECT token, n, -(ln(CASE WHEN z1 > 0 THEN 0.5 * exp(-z1 * z1 / 2) ELSE 1.0 END)
        + ln(CASE WHEN z2 > 0 THEN 0.5 * exp(-z2 * z2 / 2) ELSE 1.0 END)
        + ln(CASE WHEN z3 > 0 THEN 0.5 * exp(-z3 * z3 / 2) ELSE 1.0 END)) AS x
      FROM (SELECT *, ({CORRELATION} - abs(CASE WHEN square > 0 THEN steps / square ELSE 1.0 END))
        * sqrt(n) AS z3 FROM tests)), binned AS (
      SELECT token, token AS value, least(floor(CASE WHEN n < 2 THEN 0.0 ELSE greatest(0.0,
          (x - ln(1 + x + x * x / 2)) / ln(10.0)) END * {BINS_PER_DECADE}), {LAST_BIN})::int AS bin
      FROM combined), classed AS (
      SELECT token, bin, {classes} AS class FROM binned), counted AS (
      SELECT class, bin, sum(count(*)) OVER (PARTITION BY class ORDER BY bin DESC) AS up_to,
        sum(count(*)) OVER (PARTITION BY class) AS tested
      FROM classed GROUP BY class, bin), limits AS (
      SELECT class, min(bin) AS least FROM counted
      WHERE pow(10.0, -bin / {float(BINS_PER_DECADE)}) * tested <= {FALSE_DISCOVERIES} * up_to
      GROUP BY class), random AS (
      SELECT list(token) AS random FROM classed JOIN limits USING (class) WHERE bin >= least), kept AS (
      SELECT doc_id, base, list_sort(list_concat(base, {spans.format(
          "list_filter(tokens, lambda s: list_contains(coalesce(random, []), s.value))")})) AS spans
      FROM found, random)
    SELECT doc_id, len(list_filter(base, lambda s: s.kind = 0))::bigint AS n_assign,
      len(list_filter(base, lambda s: s.kind = 1))::bigint AS n_access,
      len(list_filter(base, lambda s: s.kind = 2))::bigint AS n_hex,
      sha256({_written_sql("base")}) AS base_sha256, {_written_sql("spans")} AS spans
    FROM kept"""


@query("op8_secrets", _secrets_sql())
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(written_spans(F.col("base")), 256).alias("base_sha256"),
        written_spans(F.col("spans")).alias("spans"),
    )


LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)


@query(
    "op5_minmax",
    rf"""WITH RECURSIVE worded AS (
      SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents), sets AS (
      SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::varchar[] ELSE list_transform(
        range(1, greatest(len(w) - 1, 2)), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
      FROM worded), items AS (
      SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets), pairs AS (
      SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c, any_value(a.n) + any_value(b.n) AS n
      FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
        AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
      GROUP BY ALL), links AS (
      SELECT i, j FROM pairs WHERE 100 * c >= 85 * (n - c)), both_ways AS (
      SELECT i, j FROM links UNION ALL SELECT j, i FROM links), reached AS (
      SELECT i, j FROM both_ways UNION
      SELECT r.i, b.j FROM reached r JOIN both_ways b ON r.j = b.i), least AS (
      SELECT i, min(j) AS j FROM reached GROUP BY i)
    SELECT doc_id, len(s)::bigint AS n_shingles, least(doc_id, j) AS component_id,
      doc_id = least(doc_id, j) AS kept
    FROM sets LEFT JOIN least ON doc_id = i""",
)
def op5_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


@query(
    "op3_pivots",
    """WITH sound AS (
      SELECT vec_id, list_transform(embedding, lambda v: floor(1024 * v::double)::bigint) AS x
      FROM embeddings
      WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding,
        lambda v: v IS NULL OR NOT isfinite(v::double))) = 0), pairs AS (
      SELECT q.vec_id AS query_id, c.vec_id,
        list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::bigint AS score
      FROM sound q JOIN sound c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id), ranked AS (
      SELECT *, row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank
      FROM pairs)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
)
def op3_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score beyond 64 bits is null; its rank is right all the same."""
    best = top_products(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)
    score = F.col("score").try_cast("long").alias("score")
    return best.select("query_id", "rank", F.col("id").alias("vec_id"), score)


@query("op7_edits")
def op7_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with three edits of its own: seven characters in the first third replaced by
    its source, a line with its language put in at two thirds, the first three characters cut."""
    size = F.length(F.coalesce("text", F.lit("")))

    def edit(start: Column, deleted: int, inserted: Column) -> Column:
        return F.struct(
            start.cast("long").alias("start"),
            F.lit(deleted).cast("long").alias("deleted"),
            inserted.alias("inserted"),
        )

    edits = F.array(
        edit(F.floor(size / 3), 7, F.col("source")),
        edit(F.floor(2 * size / 3), 0, F.concat(F.lit(" "), "lang", F.lit("\n"))),
        edit(F.lit(0), 3, F.lit("")),
    )
    docs = table(spark, sf_dir, "documents").withColumn("edits", edits)
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return count_edits(docs, ranks, public_tokenizers.PATTERN)


@query(
    "op11_naming",
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
      doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op11_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def repeating(doc_id: Column, text: Column) -> Column:
    """The text, or for one id in ten its words, with those from a place of its own on repeating."""
    crc = F.crc32(doc_id.cast("string"))
    seed = F.floor(crc / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = seed % n
        p = 1 + F.floor((n - a) / (3 + seed % 8))
        place = F.sequence(F.lit(0).cast("long"), n - 1)
        moved = F.transform(
            place,
            lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")),
        )
        return F.when(n > 0, F.array_join(moved, " ")).otherwise("")

    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    return F.when(crc % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(text)


@query("op12_runs")
def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", repeating(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs).withColumn("best", greatest_run(F.col("runs")))
    written = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(written, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# The polynomial of the checksum, with its bits reversed.
CRC = 0xEDB88320
# A table of 256 remainders, and the checksum of the digits of a number.
CRC_TABLE = f"""SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
  lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {CRC}) ELSE c >> 1 END)) AS t"""
ONES = 0xFFFFFFFF


def _crc_sql(number: str, table: str) -> str:
    return f"""xor(list_reduce(list_concat([{ONES}], list_transform(
      string_split({number}::varchar, ''), lambda c: ascii(c)::bigint)),
      lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), {ONES})"""


@query(
    "op13_trie",
    f"""WITH crc AS ({CRC_TABLE}), own AS (
      SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST) AS own
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id), taken AS (
      SELECT c, own, {_crc_sql("c", "crc.t")} % 9 AS h FROM own, crc), rebuilt AS (
      SELECT a.c, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) AS r
      FROM taken a LEFT JOIN own b ON b.c = a.c - a.c % 5), prefixes AS (
      SELECT c, d, r[1:d] AS p, len(r) = d AS ends,
        CASE WHEN d > 0 THEN strlen(r[d].t) ELSE 0 END AS bytes
      FROM (SELECT c, r, unnest(range(0, len(r) + 1)) AS d FROM rebuilt)), nodes AS (
      SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
        coalesce(string_agg(c::varchar, ',' ORDER BY c) FILTER (ends), '') AS ended
      FROM prefixes GROUP BY d, p), children AS (
      SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL), counted AS (
      SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN children k USING (d, p)), sums AS (
      SELECT a AS d, p[1:a] AS p, sum((n_children = 0)::int)::bigint AS n_leaves,
        sum((n_convs - 1) * bytes)::bigint AS saved_tokens
      FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM counted) GROUP BY ALL)
    SELECT c.conv_id, c.d AS depth, u.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves,
      s.saved_tokens, sha256(c.ended) AS ends_sha256
    FROM counted c JOIN sums s ON s.d = c.d AND s.p = c.p
      LEFT JOIN nodes u ON u.d = c.d - 1 AND u.p = c.p[1:c.d - 1]""",
)
def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose first turns, up to eight, are those of the first of five ids in a row."""
    convs = conversations(table(spark, sf_dir, "conversations"))
    c = F.col("conv_id")
    taken = (F.crc32(c.cast("string")) % 9).cast("int")
    return prefix_trie(continued(convs, c - c % 5, taken, most=8)).drop("n_ends")
