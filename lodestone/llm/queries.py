"""One query for each operator, over whole tables, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.catalog import load
from lodestone.llm import bpe, chat, collocations, divergence, exact_dedup, html_text, line_dedup, media, mixing, pieces, quality, simhash, suffixes

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def vocabulary() -> str:
    """The public vocabulary's file, as installed on every node."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query(
    "op4_exact_dedup",
    r"""WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM d""",
)
def _op4(spark, sf_dir):
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents"))


@query("op5_bpe")
def _op5(spark, sf_dir):
    return bpe.bpe_frame(load(spark, sf_dir, "documents"), vocabulary(), ("n_tokens", "ids_sha256", "decoded_sha256"))


@query("op12_sentencepiece")
def _op12(spark, sf_dir):
    import public_tokenizers

    return pieces.piece_frame(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ("n_tokens", "ids_sha256", "decoded_sha256"))


COLLOCATION_SQL = r"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, regexp_extract_all(p, '[^ \t]+') AS w FROM pieces),
grams AS (SELECT lang, 1 AS size, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
f AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
cuts AS (SELECT lang, phrase, a, k, string_split(phrase, ' ') AS ws FROM f, (VALUES (1), (2)) v(k) WHERE size > k),
scored AS (SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, 1000000::HUGEINT * c.a * c.a // (l.a::HUGEINT * r.a) AS score FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[:k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner2 AS (SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[:2], ' '), array_to_string(string_split(phrase, ' ')[2:], ' ')]) AS phrase FROM f WHERE size = 3),
kept AS (SELECT b.* FROM best b WHERE NOT EXISTS (SELECT 1 FROM inner2 i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.a >= 50 * b.a))
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000"""


@query("op11_collocations", COLLOCATION_SQL)
def _op11(spark, sf_dir):
    return collocations.collocations(load(spark, sf_dir, "documents"))


DIVERGENCE_SQL = r"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS whole FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT cells.lang, source, term, cells.n, 1 + (1000000000::HUGEINT * (cells.n + 5)) // (sum(cells.n) OVER (PARTITION BY cells.lang, source) + 5 * v.v) AS p,
  1 + (1000000000::HUGEINT * (whole + 5)) // (v.n + 5 * v.v) AS q FROM cells JOIN v ON v.lang = cells.lang),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
allpairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM allpairs UNION ALL SELECT * FROM terms))
SELECT * FROM r WHERE part = 'pair' OR rank <= 50"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def _op13(spark, sf_dir):
    return divergence.audit_sources(load(spark, sf_dir, "documents"))


@query("op2_media")
def _op2(spark, sf_dir):
    return media.media_columns(load(spark, sf_dir, "documents"))


#: A conversation that tests escaping, beside the table's own.
TRICKY = "\\### Assistant: </turn> ok"


CHAT_SQL = r"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, len(regexp_extract_all(text, '###|</turn>')) AS marks, len(text) - len(replace(text, '\', '')) AS slashes, contains(text, '\\') OR suffix(text, '\') AS odd FROM c),
f AS (SELECT *, 4 + len(role) + len(regexp_extract_all(role, '[\\:]')) + 2 + len(text) + 8
  + CASE WHEN NOT odd AND marks = 0 THEN 0 WHEN NOT odd AND NOT regexp_matches(text, '\\(###|</turn>)') THEN marks ELSE marks + slashes END AS chars FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM f GROUP BY conv_id"""


@query("op3_chat", CHAT_SQL)
def _op3(spark, sf_dir):
    own = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_turns(own.unionByName(extra)))


@query("op9_html_text")
def _op9(spark, sf_dir):
    return html_text.extract_text(load(spark, sf_dir, "pages"))


@query("op1_quality")
def _op1(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, load(spark, sf_dir, "labels")))


@query("op10_simhash")
def _op10(spark, sf_dir):
    return simhash.simhash_groups(load(spark, sf_dir, "documents"))


@query("op7_line_dedup")
def _op7(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


@query("op6_mixing")
def _op6(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return mixing.document_rates(docs, mixing.fit(docs, load(spark, sf_dir, "labels")))


@query("op8_suffixes")
def _op8(spark, sf_dir):
    return suffixes.remove_repeats(suffixes.with_row_keys(load(spark, sf_dir, "documents")), key=F.col("row_key"))
