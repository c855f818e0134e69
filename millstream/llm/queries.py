"""Queries over the test tables, one per operator, with SQL twins where SQL can say it."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.llm import decontaminate, digests, jaccard, language, lines, neighbours, pieces, quality, secrets, sharding, spelling, topk, toxicity, vectorcodes
from millstream.session import stored
from millstream.sources.readers import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_pieces")
def op1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = pieces.decode(pieces.encode(docs, model).drop("text"), model)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query(
    "op2_sharding",
    """
    WITH d AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h,
                      strlen(coalesce(text, '')) AS n FROM documents),
    p AS (SELECT doc_id, n, depth, CASE WHEN depth = 0 THEN '' ELSE right(lpad(to_base(h >> (60 - depth), 2), 60, '0'), depth) END AS shard
          FROM d, (SELECT unnest(generate_series(0, 60)) AS depth)),
    b AS (SELECT depth, shard, count(*) AS shard_rows, CAST(sum(n) AS BIGINT) AS shard_bytes FROM p GROUP BY depth, shard
          HAVING sum(n) <= 1048576 OR count(*) = 1)
    SELECT doc_id, arg_min(b.shard, depth) AS shard, arg_min(shard_rows, depth) AS shard_rows, arg_min(shard_bytes, depth) AS shard_bytes
    FROM p JOIN b USING (depth, shard) GROUP BY doc_id
    """,
)
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard of every document, of 1 MiB of text at most."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.assign(docs, 1 << 20).drop("text")


def _sql_spans(kind: str, pattern: str, group: int, least: int) -> str:
    """Spans of one kind in DuckDB, from the texts between matches and the matches."""
    return f"""
        SELECT doc_id, '{kind}' AS kind, pos + g AS s, pos + g + f AS e FROM (
            SELECT doc_id, unnest(between)[1] AS g, unnest(found)[1] AS f, unnest(judged)[1] AS j, unnest(before) AS pos FROM (
                SELECT doc_id, between, found, judged,
                       list_transform(range(len(found)), lambda i: coalesce(list_sum(list_transform(between[:i], lambda x: x[1])), 0)
                                      + coalesce(list_sum(list_transform(found[:i], lambda x: x[1])), 0)) AS before
                FROM (SELECT doc_id, list_transform(regexp_split_to_array(t, '{pattern}'), lambda x: [length(x)])[:len(regexp_extract_all(t, '{pattern}'))] AS between,
                             list_transform(regexp_extract_all(t, '{pattern}'), lambda x: [length(x)]) AS found,
                             list_transform(regexp_extract_all(t, '{pattern}', {group}), lambda x: [length(x)]) AS judged
                      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)))) WHERE j >= {least}"""


_SECRETS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
}


@query(
    "op6_secrets",
    f"""
    WITH s AS ({" UNION ALL ".join(_sql_spans(k, *v) for k, v in _SECRETS.items())}),
    j AS (SELECT doc_id, string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, list_position(['assign', 'access', 'hex'], kind)) AS spans,
                 count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h FROM s GROUP BY doc_id)
    SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
           sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN j USING (doc_id)
    """,
)
def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document."""
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, r.kind))).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE]
    rows = found.select("doc_id", *counts, joined.alias("spans"))
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("spans", 256).alias("base_sha256"), "spans")


@query(
    "op7_topk",
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
    WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
    """,
)
def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 50."""
    numbers = topk.whole_numbers(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)
    return topk.nearest(numbers, 5, repeats=True)


def fold(n: int, left_out: int) -> Column:
    """Whether a row is held out by its id; rows without id are, so nothing is learned from them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == left_out, F.lit(True))


@query("op3_quality")
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = stored(quality.with_statistics(docs).drop("text"), "statistics")
    labels = quality.labels_by_id(table(spark, folder, "labels"), "quality", ~fold(3, 1))
    model = quality.fit(scored.join(labels, "doc_id"))
    return quality.predict(scored, model).select(
        "doc_id", fold(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = quality.labels_by_id(table(spark, folder, "labels"), "toxic", ~fold(4, 2))
    model = toxicity.fit(docs, labels)
    return toxicity.predict(docs, model).select(
        "doc_id", fold(4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op5_language")
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, folder, "documents")
    net = language.fit(docs, ~fold(3, 1))
    found = language.predict(docs.select("doc_id", "text"), net)
    return found.select("doc_id", fold(3, 1).alias("held_out"), "lang_pred", "score")


@query(
    "op8_jaccard",
    r"""
    WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    g AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                 ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w),
    n AS (SELECT doc_id, len(g) AS n FROM g),
    e AS (SELECT doc_id, n, unnest(g) AS g FROM g JOIN n USING (doc_id)),
    f AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
    s AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o, any_value(a.n) AS na, any_value(b.n) AS nb
          FROM e a SEMI JOIN f ON a.g = f.g JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY 1, 2),
    l AS (SELECT a, b FROM s WHERE 100 * o >= 90 * (na + nb - o) UNION SELECT b, a FROM s WHERE 100 * o >= 90 * (na + nb - o)),
    c AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a)
    SELECT doc_id, n AS n_shingles, min(c.b) AS component_id FROM n JOIN c ON n.doc_id = c.a GROUP BY doc_id, n
    """,
)
def op8_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document by links of 3-word shingles at a similarity of 0.9."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard.similar(docs, 3, 90).select("doc_id", "n_shingles", "component_id")


def _sql_values(column: str) -> str:
    """Tokens of a text in lower case without marks in DuckDB."""
    token = decontaminate.TOKEN.replace("'", "''")
    return f"list_transform(regexp_extract_all({column}, '{token}'), lambda x: rtrim(lower(x), '.!?'))"


def _sql_template(table: str, key: str) -> str:
    """(key, w, c, v): tokens, template and values in DuckDB."""
    units = ", ".join(f"'{u}'" for u in decontaminate.UNITS)
    token = decontaminate.TOKEN.replace("'", "''")
    return f"""
        SELECT {key}, v, list_transform(range(1, len(w) + 1), lambda i: CASE
            WHEN w[i][1] BETWEEN '0' AND '9' THEN '#num'
            WHEN i > 1 AND w[i - 1][1] BETWEEN '0' AND '9' AND v[i] IN ({units}) THEN '#unit'
            WHEN lower(w[i]) = w[i] THEN v[i]
            WHEN i > 1 AND right(w[i - 1], 1) NOT IN ('.', '!', '?') AND w[i][1] <> lower(w[i][1]) AND w[i][2:] = lower(w[i][2:]) AND length(w[i]) > 1 THEN '#name'
            ELSE v[i] END) AS c
        FROM (SELECT {key}, w, list_transform(w, lambda x: rtrim(lower(x), '.!?')) AS v
              FROM (SELECT {key}, regexp_extract_all(text, '{token}') AS w FROM {table}) WHERE len(w) >= 4)"""


@query(
    "op9_decontamination",
    f"""
    WITH b AS ({_sql_template("benchmark", "item_id")}), d AS ({_sql_template("documents", "doc_id")}),
    bw AS (SELECT item_id, n, i AS pos, c[i:i + n - 1] AS c, v[i:i + n - 1] AS v
           FROM (SELECT *, least(len(c), 6) AS n, unnest(range(1, len(c) - least(len(c), 6) + 2)) AS i FROM b)
           WHERE len(list_filter(c[i:i + n - 1], lambda x: x[1] <> '#')) >= greatest(n - 2, 1)),
    t AS (SELECT item_id, count(*) AS total FROM bw GROUP BY item_id),
    dw AS (SELECT doc_id, i AS place, c[i:i + n - 1] AS c, v[i:i + n - 1] AS u
           FROM (SELECT doc_id, c, v, n, unnest(range(1, len(c) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(c) >= n)),
    m AS MATERIALIZED (SELECT doc_id, item_id, place - pos AS line, pos, n, bw.c, v, u FROM dw JOIN bw ON dw.c = bw.c),
    s AS (SELECT doc_id, item_id, line, pos, pos + k AS place, c[k] || ' ' || v[k] AS slot, c[k] AS c, v[k] AS v, u[k] AS u
          FROM (SELECT *, unnest(range(1, len(c) + 1)) AS k FROM m) WHERE c[k][1] = '#'),
    y AS (SELECT doc_id, item_id, line, slot, max({{'times': times, 'same': same, 'u': u}}).u AS usual FROM (
              SELECT doc_id, item_id, line, slot, u, u = v AS same, count(DISTINCT place) AS times FROM s GROUP BY ALL) GROUP BY ALL),
    j AS (SELECT doc_id, item_id, line, pos, bool_and(v = u) OR bool_and(u = usual) AS good FROM s JOIN y USING (doc_id, item_id, line, slot) GROUP BY ALL),
    g AS MATERIALIZED (SELECT m.* FROM m LEFT JOIN j USING (doc_id, item_id, line, pos) WHERE coalesce(good, true)),
    x AS (SELECT doc_id, item_id, line, count(DISTINCT (c, v, u)) AS changed FROM s SEMI JOIN g USING (doc_id, item_id, line, pos) WHERE v <> u GROUP BY ALL),
    r AS (SELECT doc_id, item_id, line, max(pos) + any_value(n) - min(pos) AS run FROM (
              SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id, item_id, line ORDER BY pos) AS island FROM (
                  SELECT doc_id, item_id, line, pos, n, coalesce(pos > lag(pos) OVER (PARTITION BY doc_id, item_id, line ORDER BY pos) + n, false) AS fresh FROM g))
          GROUP BY doc_id, item_id, line, island),
    f AS (SELECT g.doc_id, g.item_id, count(DISTINCT g.pos) AS windows, max(coalesce(changed, 0)) AS changed
          FROM g LEFT JOIN x USING (doc_id, item_id, line) GROUP BY ALL),
    l AS (SELECT doc_id, item_id, max(run) AS run FROM r GROUP BY ALL),
    o AS (SELECT item_id, len(v) AS n, v FROM (SELECT item_id, {_sql_values("text")} AS v FROM benchmark) ANTI JOIN bw USING (item_id) WHERE len(v) > 0),
    e AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, text FROM documents SEMI JOIN (SELECT 1 FROM o) ON true),
    q AS (SELECT doc_id, item_id FROM o JOIN (SELECT doc_id, {_sql_values("text")} AS u FROM documents SEMI JOIN (SELECT 1 FROM o) ON true)
              ON n >= 4 AND contains(' ' || array_to_string(u, ' ') || ' ', ' ' || array_to_string(v, ' ') || ' ')
          UNION SELECT doc_id, item_id FROM o JOIN (SELECT doc_id, {_sql_values("raw")} AS u FROM e) ON n < 4 AND u = v)
    SELECT doc_id, item_id, windows, windows / total AS share, changed FROM f JOIN t USING (item_id) JOIN l USING (doc_id, item_id) WHERE windows / total >= 0.4 OR run >= 13
    UNION ALL SELECT doc_id, item_id, 1, 1.0, 0 FROM q
    """,
)
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold benchmark items, also with other numbers, names or units."""
    found = decontaminate.leaks(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.drop("doc")


@query(
    "op10_lines",
    r"""
    WITH l AS (SELECT doc_id, n, raw, trim(regexp_replace(raw, '[ \t\r]+', ' ', 'g'), ' ') AS line FROM (
                   SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS n FROM documents WHERE text IS NOT NULL)),
    d AS (SELECT line, min((doc_id, n)) AS first, string_split(line, ' ') AS w, len(string_split(line, ' ')) AS m FROM l WHERE line <> '' GROUP BY line),
    k AS (SELECT d.*, big, unnest([0, 1]) AS last, unnest([w[:big // 2], w[m - big // 2 + 1:]]) AS half FROM d, (SELECT unnest([0, 1]) AS more), (SELECT m + more AS big) WHERE big >= 8),
    p AS (SELECT DISTINCT b.line, b.w, a.w AS v FROM k a JOIN k b ON a.big = b.big AND a.last = b.last AND a.half = b.half AND a.first < b.first
          WHERE greatest(a.m, b.m) = a.big),
    z AS (SELECT DISTINCT line FROM p WHERE
          coalesce(list_position(list_transform(range(1, least(len(w), len(v)) + 1), lambda i: w[i] = v[i]), false) - 1, least(len(w), len(v)))
          + coalesce(list_position(list_transform(range(1, least(len(w), len(v)) + 1), lambda i: w[-i] = v[-i]), false) - 1, least(len(w), len(v)))
          >= greatest(len(w), len(v)) - 1),
    g AS (SELECT l.doc_id, l.n, l.raw, coalesce(z.line IS NOT NULL OR (l.doc_id, l.n) > d.first, false) AS gone
          FROM l LEFT JOIN d ON l.line = d.line LEFT JOIN z ON l.line = z.line),
    r AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, coalesce(string_agg(raw, chr(10) ORDER BY n) FILTER (NOT gone), '') AS kept FROM g GROUP BY doc_id)
    SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(kept) AS text_sha256
    FROM documents LEFT JOIN r ON documents.doc_id = r.doc_id
    """,
)
def op10_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without repeated lines, as a digest."""
    made = lines.dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))

def _sql_near(books: str, parts: str = "p") -> str:
    """(vec_id, p, j, d): the nearest entry of every part in DuckDB, of equally near ones the lowest."""
    return f"""
        SELECT vec_id, p, m.j AS j, m.d AS d FROM (
            SELECT vec_id, p, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'j': j}}) AS m
            FROM {parts} JOIN {books} USING (p) GROUP BY vec_id, p)"""


def _sql_moved(books: str, near: str) -> str:
    """Codebooks with every entry that has parts at their mean in DuckDB."""
    return f"""
        SELECT p, j, coalesce(m, c) AS c FROM {books} LEFT JOIN (
            SELECT p, j, list(m ORDER BY k) AS m FROM (
                SELECT p, j, k, CAST(floor(sum(x[k]) / count(*)) AS BIGINT) AS m
                FROM (SELECT p, j, x, unnest(range(1, len(x) + 1)) AS k FROM {near} JOIN p USING (vec_id, p)) GROUP BY p, j, k) GROUP BY p, j) USING (p, j)"""


@query(
    "op11_vectorcodes",
    f"""
    WITH e AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
                            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS MATERIALIZED (SELECT vec_id, p, v[p * w + 1:p * w + w] AS x FROM e, (SELECT unnest(range(16)) AS p), (SELECT max(len(v)) // 16 AS w FROM e)),
    b0 AS MATERIALIZED (SELECT p, row_number() OVER w - 1 AS j, x AS c FROM p WINDOW w AS (PARTITION BY p ORDER BY vec_id) QUALIFY row_number() OVER w <= 64),
    a0 AS MATERIALIZED ({_sql_near("b0")}), b1 AS MATERIALIZED ({_sql_moved("b0", "a0")}),
    a1 AS MATERIALIZED ({_sql_near("b1")}), b2 AS MATERIALIZED ({_sql_moved("b1", "a1")}),
    a2 AS MATERIALIZED ({_sql_near("b2")}),
    r AS (SELECT vec_id, string_agg(format('{{:02x}}', j), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY vec_id),
    h AS (SELECT sha256(string_agg(CAST(n AS VARCHAR), ',' ORDER BY p, j, k)) AS codebooks_sha256
          FROM (SELECT p, j, unnest(c) AS n, unnest(range(len(c))) AS k FROM b2))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM e JOIN r USING (vec_id), h
    """,
)
def op11_vectorcodes(spark: SparkSession, folder: str) -> DataFrame:
    """Code and error of every vector, with the error of its label and the digest of the codebooks."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    coded, books = vectorcodes.compress(vectors)
    hexed = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    rows = coded.select("vec_id", "label", hexed.alias("code"), F.aggregate("errors", F.lit(0).cast("long"), lambda s, x: s + x).alias("error"))
    # A label's sum that exceeds a long is null.
    total = F.expr("try_cast(sum(CAST(error AS DECIMAL(38, 0))) AS BIGINT)")
    by_label = rows.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    found = rows.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _one_in_97(key: str, word: str) -> str:
    """The word without one code point, if 97 divides the CRC of key and word."""
    h = zlib.crc32(f"{key}:{word}".encode())
    at = h % len(word)
    return word if h % 97 else word[:at] + word[at + 1 :]


@query(
    "op12_spelling",
    r"""
    WITH RECURSIVE r AS (SELECT doc_id, run, count(*) AS n, CAST(doc_id AS VARCHAR) || ':' || run AS s FROM (
             SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
             FROM documents) GROUP BY doc_id, run),
    x AS (SELECT run, n, hex(encode(s)) AS x FROM r),
    c AS (SELECT run, n, xor(list_reduce([4294967295] || list_transform(range(4 * length(x)), lambda i:
                 ((strpos('0123456789ABCDEF', substr(x, 2 * (i // 8) + 2 - (i % 8) // 4, 1)) - 1) >> (i % 4)) % 2),
                 lambda c, b: xor(c // 2, 3988292384 * ((c + b) % 2))), 4294967295) AS h FROM x),
    w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
             SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM c)
         WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    v AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS v FROM (SELECT *, unnest(range(length(word))) AS i FROM w)),
    p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM v a JOIN v b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
          UNION SELECT v.word, w.word, w.n FROM v JOIN w ON v.v = w.word UNION SELECT w.word, v.word, v.n FROM v JOIN w ON v.v = w.word),
    b AS (SELECT word, count(*) AS n_near, min({'less': -near_n, 'near': near}) AS best FROM p GROUP BY word),
    f AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 2 * n THEN best.near END AS form, CASE WHEN -best.less >= 2 * n THEN -best.less END AS form_n
          FROM w LEFT JOIN b USING (word)),
    t AS (SELECT word, word AS root, 0 AS depth FROM f UNION ALL SELECT t.word, f.form, depth + 1 FROM t JOIN f ON t.root = f.word WHERE f.form IS NOT NULL)
    SELECT word, form, l.root, n, n_near, form_n FROM f JOIN (SELECT word, arg_max(root, depth) AS root FROM t GROUP BY word) l USING (word)
    """,
)
def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Usual spelling of every frequent word of the documents, some of whose words lost a letter."""
    return spelling.group(spelling.vocabulary(table(spark, folder, "documents"), key="doc_id", change=_one_in_97))


def _edited(own: str | None, following: str | None) -> str:
    """A text whose last third is replaced by as much of the beginning of the next one."""
    own, following = own or "", following or ""
    n = len(own) // 3
    return own[: len(own) - n] + following[:n]


@query("op13_digests")
def op13_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how like the next document is."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = neighbours.in_order(docs, F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    ordered = digests.fingerprint(ordered.withColumn("n_chars", F.length("text").cast("long")))

    def start():
        def work(own, following):
            edited = [_edited(a, b) for a, b in zip(own[0].to_pylist(), following[0].to_pylist())]
            shas = [hashlib.sha256(t.encode()).hexdigest() for t in edited]
            prints, changed = own[1].to_pylist(), digests.digests(edited)
            likes = [digests.alike(prints, other).data for other in (changed, following[1].to_pylist())]
            return [pa.array(shas, pa.string()), pa.array(changed, pa.string()), *[pa.array(x, pa.float64()) for x in likes]]

        return work

    kinds = {"edited_sha256": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}
    fields = T.StructType.fromDDL(", ".join(f"{c} {kind}" for c, kind in kinds.items())).fields
    return neighbours.add_from_next(ordered, ["text", "fingerprint"], fields, start, ["doc_id", "n_chars", "fingerprint"])
