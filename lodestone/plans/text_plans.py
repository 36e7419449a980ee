"""Classification, harmonisation, masking, citations and answer checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone import functions as fn
from lodestone.catalog import load
from lodestone.operators import gates, injuries, metrics, text
from lodestone.plans.registry import query

# Kinds of parts by the first pattern that fits their type.
PART_RULES = (("precious", r"gold|silver|platinum"), ("steel", r"\bsteel"), ("copper", r"copper|brass"), ("treated", r"anodized|plated|polished"))
PART_NONSPECIFIC = r"standard|economy|^type"
LADDER_SQL = (
    "CASE WHEN trim(lower({c})) = '' OR {c} IS NULL THEN NULL "
    + " ".join(f"WHEN regexp_matches(trim(lower({{c}})), '{p}') THEN '{n}'" for n, p in PART_RULES)
    + f" WHEN regexp_matches(trim(lower({{c}})), '{PART_NONSPECIFIC}') THEN NULL ELSE 'other' END"
)


@query("ordered_rule_class", f"SELECT p_partkey, {LADDER_SQL.format(c='p_type')} AS kind FROM part")
def _(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", text.first_match(F.col("p_type"), PART_RULES, PART_NONSPECIFIC).alias("kind"))


NATURE_SQL = (
    "CASE WHEN trim(t) = '' THEN NULL "
    + " ".join(f"WHEN regexp_matches(trim(t), '{p}') THEN '{n}'" for n, p in text.NATURE_PATTERNS)
    + f" WHEN regexp_matches(trim(t), '{text.NATURE_NONSPECIFIC}') THEN NULL ELSE 'other' END"
)
TITLES = ["Amputations", "Fractures, ribs", "Heat stroke", "Electrocution, electric shock", "Cuts, lacerations", "Soreness, pain", "Nonclassifiable", "Frostbite", "", "Crushing injuries", "Internal injuries", "Sprains, strains, tears"]
TITLE_SQL = "[" + ", ".join(f"'{t}'" for t in TITLES) + "]"


def titled(spark, sf_dir):
    """Injury titles dealt to parts by key, so that every rule has rows."""
    titles = F.array(*(F.lit(t) for t in TITLES))
    return load(spark, sf_dir, "part").select("p_partkey", "p_size", F.element_at(titles, (F.col("p_partkey") % len(TITLES) + 1).cast("int")).alias("title"))


@query("nature_types", f"WITH n AS (SELECT p_partkey, lower({TITLE_SQL}[p_partkey % {len(TITLES)} + 1]) AS t FROM part) SELECT p_partkey, {NATURE_SQL} AS nature FROM n")
def _(spark, sf_dir):
    return titled(spark, sf_dir).select("p_partkey", text.nature_type(F.col("title")).alias("nature"))


# Harmonised divisions: codes are sizes, titles are brands, the current era is every second part.
HARMONISE = """h AS (SELECT p_partkey, CAST(p_size AS VARCHAR) AS code, CASE WHEN p_partkey % 40 = 0 THEN 'Hips, thigh' WHEN p_partkey % 41 = 0 THEN 'Part of body, unspecified' ELSE p_brand END AS title,
  CASE WHEN p_partkey % 2 = 0 THEN '2024-05' ELSE '2019-05' END AS month FROM part),
n AS (SELECT *, trim(regexp_replace(lower(title), '[^a-z0-9.]+', ' ', 'g')) AS t, left(code, 1) AS own FROM h),
m AS (SELECT t, own AS mode FROM (SELECT t, own, count(*) AS c FROM n WHERE month >= '2024-01' GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY t ORDER BY c DESC, own) = 1),
d AS (SELECT n.*, CASE WHEN regexp_matches(n.t, '\\bhips?\\b') AND NOT contains(n.t, 'trunk') THEN '5' ELSE coalesce(m.mode, own) END AS division FROM n LEFT JOIN m ON n.t = m.t)"""
NAMES_SQL = "CASE division " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in text.DIVISIONS["body_part"].items()) + " END"


def coded_parts(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_size").cast("string").alias("code"),
        F.when(F.col("p_partkey") % 40 == 0, "Hips, thigh").when(F.col("p_partkey") % 41 == 0, "Part of body, unspecified").otherwise(F.col("p_brand")).alias("title"),
        F.when(F.col("p_partkey") % 2 == 0, "2024-05").otherwise("2019-05").alias("month"),
    )


@query(
    "mode_harmonize",
    f"WITH {HARMONISE} SELECT p_partkey, CASE WHEN month >= '2024-01' THEN '2024-25' ELSE '2015-23' END AS era, division, CASE WHEN regexp_matches(t, '^nonclassifiable$|^part of body\\b') THEN NULL ELSE {NAMES_SQL} END AS body_part, division IS DISTINCT FROM own AS changed FROM d",
)
def _(spark, sf_dir):
    out = text.harmonise(coded_parts(spark, sf_dir), "body_part", "code", "title", "month")
    return out.select("p_partkey", text.era(F.col("month")).alias("era"), F.col("body_part_division").alias("division"), "body_part", F.col("body_part_changed").alias("changed"))


def _shown_sql(label, field):
    return f"coalesce(CASE {label} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in injuries.SHOWN[field].items()) + f" END, '{injuries.NOWHERE[field]}')"


def _field_sql(field):
    """Titles and codes of one field, harmonised: the current era's most frequent division of a title, hips apart."""
    own = "left(code, 1)"
    hips = "WHEN regexp_matches(n.t, '\\bhips?\\b') AND NOT contains(n.t, 'trunk') THEN '5' " if field == "body_part" else ""
    names = "CASE division " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in text.DIVISIONS[field].items()) + " END"
    unplaced = text.UNSCOREABLE[field]
    return f"""{field}_n AS (SELECT id, month, {own} AS own, trim(regexp_replace(lower({field}_title), '[^a-z0-9.]+', ' ', 'g')) AS t FROM (SELECT *, {field}_code AS code FROM raw)),
{field}_m AS (SELECT t, own AS mode FROM (SELECT t, own, count(*) AS c FROM {field}_n WHERE month >= '2024-01' GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY t ORDER BY c DESC, own) = 1),
{field}_d AS (SELECT n.id, n.t, CASE {hips}WHEN true THEN coalesce(m.mode, n.own) END AS division FROM {field}_n n LEFT JOIN {field}_m m ON n.t = m.t),
{field}_f AS (SELECT id, {_shown_sql(f"(CASE WHEN regexp_matches(t, '{unplaced}') THEN NULL ELSE {names} END)", field)} AS {field}_category FROM {field}_d)"""


RAW_FACTS = f"""raw AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN '2024-05' ELSE '2019-05' END AS month, CAST(p_size AS VARCHAR) AS body_part_code,
  CASE WHEN p_partkey % 40 = 0 THEN 'Hips, thigh' WHEN p_partkey % 41 = 0 THEN 'Part of body, unspecified' ELSE p_brand END AS body_part_title, CAST(p_size % 9 AS VARCHAR) || '10' AS event_code, CASE WHEN p_partkey % 17 = 0 THEN 'Nonclassifiable' ELSE p_type END AS event_title,
  CAST(p_partkey % 10 AS VARCHAR) AS source_code, CASE WHEN p_partkey % 19 = 0 THEN 'Source, n.e.c.' ELSE 'Kind ' || p_partkey % 31 END AS source_title, CAST(11 + p_partkey % 88 AS VARCHAR) || '1' AS naics,
  {TITLE_SQL}[p_partkey % {len(TITLES)} + 1] AS nature_title FROM part)"""


@query(
    "injury_facts",
    f"""WITH {RAW_FACTS}, {", ".join(_field_sql(f) for f in ("event", "body_part", "source"))}, k AS (SELECT id, {NATURE_SQL.replace("trim(t)", "trim(lower(nature_title))")} AS nature FROM raw)
SELECT raw.id AS report_id, month AS event_month, month || '-01' AS event_date, CAST(left(month, 4) AS INTEGER) AS event_year, CASE WHEN month >= '2024-01' THEN '2024-25' ELSE '2015-23' END AS coding_era, 'TX' AS state, naics, left(naics, 2) AS naics_sector,
  coalesce(CASE left(naics, 2) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in injuries.SECTORS.items())} END, '{injuries.UNKNOWN_SECTOR}') AS industry_sector, event_category, {_shown_sql("k.nature", "nature")} AS nature_category, body_part_category, source_category,
  CASE WHEN raw.id % 9 <> 0 THEN CAST(raw.id % 3 AS INTEGER) END AS hospitalized, CASE WHEN raw.id % 7 <> 0 THEN CAST(raw.id % 2 AS INTEGER) END AS amputation, CAST(NULL AS INTEGER) AS loss_of_eye, CASE WHEN raw.id % 5 <> 0 THEN raw.id % 2 = 0 END AS inspected
FROM raw JOIN event_f USING (id) JOIN body_part_f USING (id) JOIN source_f USING (id) JOIN k USING (id)""",
)
def _(spark, sf_dir):
    i, of = F.col("p_partkey"), lambda n: F.col("p_partkey") % n
    coded = coded_parts(spark, sf_dir).join(titled(spark, sf_dir).select("p_partkey", F.col("title").alias("nature_title")), "p_partkey")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    naics = F.concat((of(88) + 11).cast("string"), F.lit("1"))
    reports = coded.join(part, "p_partkey").select(
        i.alias("report_id"),
        F.col("month").alias("event_month"),
        F.substring("month", 1, 4).alias("event_year"),
        F.lit("TX").alias("state"),
        naics.alias("naics"),
        F.substring(naics, 1, 2).alias("naics_sector"),
        F.col("code").alias("body_part_code"),
        F.col("title").alias("body_part_title"),
        F.concat((F.col("p_size") % 9).cast("string"), F.lit("10")).alias("event_code"),
        F.when(of(17) == 0, "Nonclassifiable").otherwise(F.col("p_type")).alias("event_title"),
        of(10).cast("string").alias("source_code"),
        F.when(of(19) == 0, "Source, n.e.c.").otherwise(F.concat(F.lit("Kind "), of(31).cast("string"))).alias("source_title"),
        "nature_title",
        F.when(of(9) != 0, of(3)).alias("hospitalized"),
        F.when(of(7) != 0, of(2)).alias("amputation"),
        F.lit(None).cast("int").alias("loss_of_eye"),
        F.when(of(5) != 0, of(2) == 0).alias("inspected"),
    )
    return injuries.injury_facts(reports).withColumn("event_date", F.col("event_date").cast("string"))


# Fixed value: what the split's hash begins with.
SPLIT_SALT = "osha-extraction-v1"
SPLIT_SQL = f"CAST(('0x' || left(sha256('{SPLIT_SALT}:' || {{k}}), 8)) AS BIGINT) % 1000"


@query("hash_split", f"WITH b AS (SELECT doc_id, {SPLIT_SQL.format(k='doc_id')} AS bucket FROM documents) SELECT doc_id, CASE WHEN bucket < 10 THEN 'test' WHEN bucket < 11 THEN 'dev' ELSE 'train' END AS split FROM b")
def _(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", text.hash_split(F.col("doc_id"), SPLIT_SALT).alias("split"))


@query("group_split", "WITH u AS (SELECT DISTINCT user_id FROM events) SELECT user_id, CAST(('0x' || left(sha256('42:' || user_id), 8)) AS BIGINT) % 1000 < 200 AS validation FROM u")
def _(spark, sf_dir):
    return load(spark, sf_dir, "events").select("user_id").distinct().select("user_id", gates.group_split(F.col("user_id")).alias("validation"))


# A rule predicts quality from length and symbols.
PREDICT = "p AS (SELECT l.doc_id, CAST(l.quality AS VARCHAR) AS truth, CAST(CASE WHEN d.n_chars > 400 AND NOT regexp_matches(d.text, '[#*$%&]{3}') THEN 1 ELSE 0 END AS VARCHAR) AS predicted, d.lang FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"


def judged(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", F.when((F.col("n_chars") > 400) & ~F.col("text").rlike("[#*$%&]{3}"), "1").otherwise("0").alias("predicted"))
    return load(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("truth")).join(docs, "doc_id")


@query("confusion_matrix", f"WITH {PREDICT} SELECT truth, count(*) FILTER (predicted = '0') AS \"0\", count(*) FILTER (predicted = '1') AS \"1\" FROM p GROUP BY truth")
def _(spark, sf_dir):
    return metrics.confusion(judged(spark, sf_dir), "truth", "predicted", ["0", "1"])


@query(
    "confusion_f1",
    f"""WITH {PREDICT}, x AS (SELECT label, count(*) FILTER (truth = label) AS support, count(*) FILTER (predicted = label) AS predicted, count(*) FILTER (truth = label AND predicted = label) AS correct FROM p, (VALUES ('0'), ('1')) v(label) GROUP BY label)
SELECT label, support, predicted, correct, round(coalesce(correct / nullif(predicted, 0), 0), 6) AS precision, round(coalesce(correct / nullif(support, 0), 0), 6) AS recall, round(coalesce(2 * correct / nullif(predicted + support, 0), 0), 6) AS f1 FROM x""",
)
def _(spark, sf_dir):
    out = metrics.label_scores(judged(spark, sf_dir), "truth", "predicted")
    return out.select("label", "support", "predicted", "correct", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


@query(
    "macro_f1",
    f"""WITH {PREDICT}, x AS (SELECT label, 2 * count(*) FILTER (truth = label AND predicted = label) / nullif(count(*) FILTER (truth = label) + count(*) FILTER (predicted = label), 0) AS f1 FROM p, (VALUES ('0'), ('1')) v(label) GROUP BY label)
SELECT round(avg(f1), 6) AS macro_f1, (SELECT round(avg(CASE WHEN truth = predicted THEN 1 ELSE 0 END), 6) FROM p) AS accuracy, (SELECT count(*) FROM p) AS rows FROM x""",
)
def _(spark, sf_dir):
    j = judged(spark, sf_dir)
    f1 = metrics.label_scores(j, "truth", "predicted").agg(F.round(F.avg("f1"), 6).alias("macro_f1"))
    total = metrics.accuracy(j, "truth", "predicted").select(F.round("accuracy", 6).alias("accuracy"), "rows")
    return f1.join(total)  # one row each


@query("accuracy_by_language", f"WITH {PREDICT} SELECT lang, count(*) AS rows, round(avg(CASE WHEN truth = predicted THEN 1 ELSE 0 END), 6) AS accuracy FROM p GROUP BY lang")
def _(spark, sf_dir):
    return metrics.accuracy(judged(spark, sf_dir), "truth", "predicted", ["lang"]).select("lang", "rows", F.round("accuracy", 6).alias("accuracy"))


@query("mode_label", "SELECT lang, source AS mode FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) = 1")
def _(spark, sf_dir):
    return metrics.mode_per_group(load(spark, sf_dir, "documents"), ["lang"], "source")


@query(
    "doc_frequency",
    """WITH w AS (SELECT doc_id, unnest(list_distinct(list_filter(regexp_extract_all(text, '[A-Za-z][A-Za-z''&-]+'), lambda x: x = lower(x)))) AS word FROM documents)
SELECT word, count(*) AS documents FROM w GROUP BY word HAVING count(*) >= 50""",
)
def _(spark, sf_dir):
    return text.document_frequency(load(spark, sf_dir, "documents"), "text")


# Citations: each assistant turn gets brackets made of its own numbers.
CITED_SQL = "c AS (SELECT conv_id, turn, 'First part [' || conv_id || ', ' || turn || ']. Then 【' || (conv_id + 1) || '】 and ［x］ end. Nothing here! Last one: [' || turn || '].' AS t, [conv_id, turn] AS known FROM conversations WHERE role = 'assistant')"


def cited(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").filter("role = 'assistant'")
    said = F.format_string("First part [%d, %d]. Then 【%d】 and ［x］ end. Nothing here! Last one: [%d].", "conv_id", "turn", F.col("conv_id") + 1, "turn")
    return c.select("conv_id", "turn", text.normal_brackets(said).alias("said"), F.array("conv_id", "turn").alias("known"))


@query(
    "citations",
    f"""WITH {CITED_SQL}, n AS (SELECT *, translate(t, '【】［］', '[][]') AS s FROM c), i AS (SELECT *, list_transform(flatten(list_transform(regexp_extract_all(s, '\\[(\\d+(?:\\s*,\\s*\\d+)*)\\]', 1), lambda g: regexp_split_to_array(g, '\\s*,\\s*'))), lambda x: CAST(x AS BIGINT)) AS ids FROM n)
SELECT conv_id, turn, array_to_string(list_sort(list_distinct(ids)), ',') AS cited, array_to_string(list_sort(list_filter(list_distinct(ids), lambda x: NOT list_contains(known, x))), ',') AS invalid, len(ids) AS mentions FROM i""",
)
def _(spark, sf_dir):
    checked = text.check_citations(cited(spark, sf_dir), "said", "known")
    return checked.select("conv_id", "turn", F.array_join("cited_ids", ",").alias("cited"), F.array_join("invalid_ids", ",").alias("invalid"), F.size(text.cited_ids(F.col("said"))).alias("mentions"))


# Answers of one to four facts, some with a citation, some after an introduction, some followed by a bare citation.
FACTS_SQL = """f AS (SELECT conv_id, turn, unnest(range(1, conv_id % 4 + 2)) AS i FROM conversations WHERE role = 'assistant'),
g AS (SELECT conv_id, turn, i, (i + turn) % 2 = 0 OR i = 4 AS has, CASE WHEN i = 3 AND turn % 5 = 1 THEN -1 ELSE conv_id END AS id FROM f)"""


def facts(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").filter("role = 'assistant'")
    cites = lambda i: ((i + F.col("turn")) % 2 == 0) | (i == 4)
    cited_id = lambda i: F.when((i == 3) & (F.col("turn") % 5 == 1), F.lit("7777777")).otherwise(F.col("conv_id").cast("string"))
    fact = lambda i: F.concat(F.lit("Fact "), i.cast("string"), F.when(cites(i), F.concat(F.lit(" ["), cited_id(i), F.lit("]"))).otherwise(""), F.lit("."))
    said = F.array_join(F.transform(F.sequence(F.lit(1), (F.col("conv_id") % 4 + 1).cast("int")), fact), " ")
    intro = F.when(F.col("conv_id") % 2 == 0, F.lit("These reports say:\n")).otherwise("")
    last = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("\n["), F.col("conv_id").cast("string"), F.lit("]"))).otherwise("")
    return c.select("conv_id", "turn", F.concat(intro, said, last).alias("said"), F.array("conv_id").alias("known"))


@query(
    "citation_coverage",
    f"""WITH {FACTS_SQL}, k AS (SELECT conv_id, turn, count(*) AS claims, count(*) FILTER (NOT has) AS uncited, count(*) FILTER (has) > 0 OR turn % 3 = 0 AS any_cited, count(*) FILTER (has AND id = -1) = 0 AS all_known FROM g GROUP BY conv_id, turn)
SELECT conv_id, turn, claims::INTEGER AS claims, uncited::INTEGER AS uncited, round(1 - uncited / claims, 6) AS coverage, any_cited AND all_known AS valid FROM k""",
)
def _(spark, sf_dir):
    return text.check_citations(facts(spark, sf_dir), "said", "known").select("conv_id", "turn", "claims", "uncited", F.round("coverage", 6).alias("coverage"), "valid")


@query(
    "sentences",
    r"""WITH c AS (SELECT conv_id, turn, regexp_split_to_array(coalesce(text, ''), '\r\n|[\n\r]') AS lines FROM conversations WHERE role = 'assistant'),
l AS (SELECT conv_id, turn, i, regexp_replace(lines[i], '^[ \t\n\x0B\f\r]*([-*•]|\d+[.)])[ \t\n\x0B\f\r]+', '') AS line FROM c, unnest(range(1, len(lines) + 1)) r(i)),
m AS (SELECT conv_id, turn, i, regexp_replace(regexp_replace(line, '([.!?])[ \t\n\x0B\f\r]+([^ \t\n\x0B\f\r\[])', '\1' || chr(1) || '\2', 'g'), '(\])[ \t\n\x0B\f\r]+([A-Z])', '\1' || chr(1) || '\2', 'g') AS line FROM l),
p AS (SELECT conv_id, turn, i, j, trim(string_split(line, chr(1))[j]) AS s FROM m, unnest(range(1, len(string_split(line, chr(1))) + 1)) r(j)),
k AS (SELECT * FROM p WHERE s <> '' AND NOT ends_with(s, ':') AND trim(regexp_replace(s, '\[\d+(\s*,\s*\d+)*\]', '', 'g'), ' .') <> '')
SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY i, j) - 1 AS INTEGER) AS place, s AS sentence FROM k""",
)
def _(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").filter("role = 'assistant'")
    return c.select("conv_id", "turn", F.posexplode(text.sentences(F.col("text"))).alias("place", "sentence"))


ANSWER = """a AS (SELECT conv_id, turn, (conv_id * 37 + turn * 11) % 100 / 100.0 AS top1, CASE WHEN conv_id % 13 = 0 THEN NULL WHEN conv_id % 7 = 0 THEN text || ' INSUFFICIENT' ELSE text END AS reply, CASE WHEN turn % 5 = 4 THEN 'length' ELSE 'stop' END AS finish, conv_id % 3 <> 0 AS valid FROM conversations WHERE role = 'assistant'),
s AS (SELECT conv_id, turn, CASE WHEN top1 < 0.3 THEN 'declined_low_similarity' WHEN reply IS NULL OR reply = '' OR finish = 'length' THEN 'error' WHEN contains(reply, 'INSUFFICIENT') THEN 'declined_insufficient_evidence' WHEN NOT valid THEN 'rejected_invalid_citations' ELSE 'answered' END AS status, top1 FROM a)"""


def answers(spark, sf_dir):
    a = load(spark, sf_dir, "conversations").filter("role = 'assistant'").select(
        "conv_id",
        "turn",
        ((F.col("conv_id") * 37 + F.col("turn") * 11) % 100 / 100.0).alias("top1"),
        F.when(F.col("conv_id") % 13 != 0, F.when(F.col("conv_id") % 7 == 0, F.concat("text", F.lit(" INSUFFICIENT"))).otherwise(F.col("text"))).alias("reply"),
        F.when(F.col("turn") % 5 == 4, "length").otherwise("stop").alias("finish"),
        (F.col("conv_id") % 3 != 0).alias("valid"),
    )
    status = text.answer_status(F.col("top1"), 0.3, F.col("reply"), F.col("finish"), F.col("valid"), "INSUFFICIENT")
    return a.select("conv_id", "turn", status.alias("status"), "top1")


@query("answer_status", f"WITH {ANSWER} SELECT conv_id, turn, status FROM s")
def _(spark, sf_dir):
    return answers(spark, sf_dir).select("conv_id", "turn", "status")


@query("answer_rates", f"WITH {ANSWER} SELECT status, count(*) AS answers, round(count(*) / (SELECT count(*) FROM s), 6) AS rate FROM s GROUP BY status")
def _(spark, sf_dir):
    a = answers(spark, sf_dir)
    total = a.agg(F.count(F.lit(1)).alias("n"))
    return a.groupBy("status").agg(F.count(F.lit(1)).alias("answers")).join(total).select("status", "answers", F.round(F.col("answers") / F.col("n"), 6).alias("rate"))


@query(
    "decline_routes",
    f"""WITH {ANSWER} SELECT status, count(*) FILTER (top1 >= 0.3) AS above, count(*) FILTER (top1 < 0.3) AS below, count(*) FILTER (abs(top1 - 0.3) <= 0.02) AS near, count(DISTINCT conv_id) AS conversations, min(conv_id) AS first_conversation
FROM s WHERE status LIKE 'declined%' GROUP BY status""",
)
def _(spark, sf_dir):
    a = answers(spark, sf_dir).filter(F.col("status").startswith("declined"))
    return a.groupBy("status").agg(
        F.count_if(F.col("top1") >= 0.3).alias("above"), F.count_if(F.col("top1") < 0.3).alias("below"), F.count_if(F.abs(F.col("top1") - 0.3) <= 0.02).alias("near"), F.count_distinct("conv_id").alias("conversations"), F.min("conv_id").alias("first_conversation")
    )


MASK_SQL = f"""WITH p AS (SELECT doc_id, text || printf(' at %d North Main Street, Austin, TX %05d.', doc_id % 900 + 1, doc_id % 90000) AS t FROM documents),
w AS (SELECT doc_id, trim(regexp_replace(t, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) AS t FROM p)
SELECT doc_id, sha256(regexp_replace(regexp_replace(t, '{text.STREET}', '[ADDRESS]', 'g'), '{text.STATE_ZIP}', '\\1 [ZIP]', 'g')) AS masked_sha256 FROM w"""


@query("mask_patterns", MASK_SQL)
def _(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    placed = F.concat(F.col("text"), F.format_string(" at %d North Main Street, Austin, TX %05d.", F.col("doc_id") % 900 + 1, F.col("doc_id") % 90000))
    return docs.select("doc_id", F.sha2(text.mask_patterns(placed), 256).alias("masked_sha256"))


# Employers of five kinds: with a legal suffix, with a trading name, of business words only, a short name, none. Each
# narrative has the full name, the name in large and in small letters, one of its words in both, and addresses.
EMPLOYERS = {0: ("% Tooling, Inc.", "% Tooling", "Tooling"), 1: ("% Works LLC dba Quick Oaks", "% Works LLC dba Quick Oaks", "Quick Oaks"), 2: ("General Services Co", "General Services", "General"), 3: ("Acme", "Acme", "Acme"), 4: ("", "Nobody", "None")}
#: Which of the five mentions go, by kind of employer.
GOES = {0: (1, 1, 1, 1, 0), 1: (1, 1, 1, 1, 0), 2: (1, 1, 1, 0, 0), 3: (1, 1, 0, 1, 0), 4: (0, 0, 0, 0, 0)}


def _mention_sql(j):
    def said(kind):
        name = ("replace('{}', '%', c_mktsegment)".format(EMPLOYERS[kind][min(j, 1) if j < 3 else 2]))
        return (name, f"upper({name})", f"lower({name})", name, f"lower({name})")[j]

    return "CASE c_custkey % 5 " + " ".join(f"WHEN {k} THEN {repr('[EMPLOYER]') if GOES[k][j] else said(k)}" for k in GOES) + " END"


MASKED = "'Hurt at ' || {} || ', then ' || {} || ', then ' || {} || ' and ' || {} || ' or ' || {} || ', at [ADDRESS], Reno, NV [ZIP], not at ' || c_custkey || ' oaks, mail to [ADDRESS]; NV 1234.'".format(*map(_mention_sql, range(5)))
COUNT = " + ".join(f"(length(masked) - length(replace(masked, '{t}', ''))) // {len(t)}" for t in ("[EMPLOYER]", "[ADDRESS]", "[ZIP]"))


@query("mask_reports", f"WITH m AS (SELECT c_custkey, {MASKED} AS masked FROM customer) SELECT c_custkey, masked, CAST({COUNT} AS INTEGER) AS masked_places FROM m")
def _(spark, sf_dir):
    c = load(spark, sf_dir, "customer")

    def of(place):
        kind = lambda k: F.regexp_replace(F.lit(EMPLOYERS[k][place]), "%", F.col("c_mktsegment"))
        return F.element_at(F.array(*map(kind, EMPLOYERS)), (F.col("c_custkey") % 5 + 1).cast("int"))

    parts = c.select("c_custkey", of(0).alias("full"), of(1).alias("core"), of(2).alias("word"))
    narrative = F.format_string("Hurt at %s, then %s, then  %s\nand %s or %s, at 12 Oak Street, Reno, NV 89501, not at %d oaks, mail to  po box %d; NV 1234.", "full", F.upper("core"), F.lower("core"), "word", F.lower("word"), "c_custkey", "c_custkey")
    reports = parts.select("c_custkey", narrative.alias("narrative"), F.nullif("full", F.lit("")).alias("employer"), F.format_string("PO  Box %d", "c_custkey").alias("address"))
    return text.mask_reports(reports, "narrative", "employer", ["address"], ["oaks"]).select("c_custkey", "masked", "masked_places")


# Employers of four kinds by nation; answers name them in five ways and cite the own nation's report or another's.
LEAKS_SQL = """a AS (SELECT c_custkey, c_custkey % 5 AS said, c_nationkey AS n, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey ELSE (c_nationkey + 4) % 25 END AS m FROM customer)
SELECT c_custkey, 'any_report_employer_phrase' AS kind FROM a WHERE said = 0 AND n % 4 IN (0, 3) OR said = 3 AND n % 4 = 0
UNION ALL SELECT c_custkey, 'cited_report_employer' FROM a WHERE said IN (0, 2, 3) AND (m = n AND m % 4 <> 1 OR m % 4 = 0 AND (said <> 0 OR n % 4 = 0))"""


@query("leaked_names", f"WITH {LEAKS_SQL}")
def _(spark, sf_dir):
    brand = lambda c: F.concat(F.lit("Brand"), F.char(97 + F.col(c)))
    form = lambda c, tail: F.when(F.col(c) % 4 == 0, F.concat(brand(c), F.lit(" Foods"), F.lit(tail[0]))).when(F.col(c) % 4 == 1, F.lit("United Services" + tail[1])).when(F.col(c) % 4 == 2, brand(c)).otherwise(F.concat(F.lit("The "), brand(c), F.lit(tail[2])))
    names = load(spark, sf_dir, "nation").select("n_nationkey", form("n_nationkey", (", Inc.", " LLC", " Company")).alias("name"))
    said, plain = F.col("c_custkey") % 5, form("c_nationkey", ("", "", ""))
    answer = (
        F.when(said == 0, F.concat(F.lit("Work at "), plain, F.lit(" stopped.")))
        .when(said == 1, F.concat(F.lit("Work at "), F.lower(plain), F.lit(" stopped, foods spoiled.")))
        .when(said == 2, F.concat(F.lit("They met "), brand("c_nationkey"), F.lit(". Foods arrived.")))
        .when(said == 3, F.concat(F.lit("UNITED   SERVICES and "), F.upper(brand("c_nationkey")), F.lit("  FOODS")))
    )
    cited_ids = F.array(F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey")).otherwise((F.col("c_nationkey") + 4) % 25))
    answers = load(spark, sf_dir, "customer").select("c_custkey", answer.alias("answer"), cited_ids.alias("cited"))
    return text.leaked_names(answers, "c_custkey", "answer", "cited", names, "n_nationkey", "name")


@query("relevance_rules", "SELECT p_partkey FROM part WHERE (regexp_matches(lower(coalesce(p_type, '')), 'economy|small|bolt|gear') OR regexp_matches(lower(coalesce(p_name, '')), 'economy|small|bolt|gear')) AND regexp_matches(lower(coalesce(p_brand, '')), 'brand#[1-3]')")
def _(spark, sf_dir):
    from lodestone.operators.vector import relevance

    return load(spark, sf_dir, "part").filter(relevance([(["p_type", "p_name"], "economy|small|bolt|gear"), (["p_brand"], "brand#[1-3]")])).select("p_partkey")


JSON_SQL = """j AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"kind": "view"}' WHEN 1 THEN '{"kind": "odd"}' WHEN 2 THEN '{"other": 1}' ELSE '[1]' END AS raw FROM events)"""


@query(
    "structured_output",
    f"""WITH {JSON_SQL} SELECT event_id, CASE WHEN json_type(raw) <> 'OBJECT' THEN NULL WHEN json_extract_string(raw, '$.kind') IN ('view', 'click') THEN json_extract_string(raw, '$.kind') END AS label,
CASE WHEN json_type(raw) <> 'OBJECT' THEN 'not a JSON object' WHEN json_extract_string(raw, '$.kind') IS NULL THEN 'missing' WHEN json_extract_string(raw, '$.kind') NOT IN ('view', 'click') THEN 'not allowed' END AS reason FROM j""",
)
def _(spark, sf_dir):
    raws = F.array(*(F.lit(x) for x in ('{"kind": "view"}', '{"kind": "odd"}', '{"other": 1}', "[1]")))
    j = load(spark, sf_dir, "events").select("event_id", F.element_at(raws, (F.col("event_id") % 4 + 1).cast("int")).alias("raw"))
    label, reason = text.validated_label(F.col("raw"), "kind", ["view", "click"])
    return j.select("event_id", label.alias("label"), reason.alias("reason"))


@query(
    "document_assembly",
    """SELECT doc_id, sha256(concat_ws(chr(10), 'Document ' || doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Language: ' || lang END, nullif('', '')) || chr(10) || chr(10) || text) AS document_hash, substr(source, 4, 2) AS sector FROM documents""",
)
def _(spark, sf_dir):
    header = [F.concat(F.lit("Document "), F.col("doc_id").cast("string")), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Language: "), "lang"))]
    return load(spark, sf_dir, "documents").select("doc_id", fn.content_hash(fn.document(header, F.col("text"))).alias("document_hash"), F.substring("source", 4, 2).alias("sector"))


@query(
    "answer_prompts",
    """SELECT 'Question ' || conv_id || '?' AS question, sha256('Question: Question ' || conv_id || '?' || chr(10) || chr(10) || 'Reports:' || chr(10) || string_agg('<report id="' || turn || '">' || chr(10) || text || chr(10) || '</report>', chr(10) ORDER BY turn)) AS prompt FROM conversations GROUP BY conv_id""",
)
def _(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").withColumn("question", F.format_string("Question %d?", "conv_id"))
    made = text.chat_prompt(c, "question", "turn", "text", "turn", "Answer from the reports.")
    return made.select("question", F.sha2(F.element_at("messages", 2)["content"], 256).alias("prompt"))


@query("text_baseline")
def _(spark, sf_dir):
    j = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id").select("doc_id", "text", F.col("quality").cast("string").alias("quality"))
    held = text.hash_split(F.col("doc_id"), "baseline", test=250)
    model, majority = gates.text_baseline(j.filter(held != "test"), "text", "quality")
    return model.transform(j.filter(held == "test")).select("doc_id", "quality", F.col("_p").cast("int").alias("predicted"), F.lit(majority).alias("majority"))


@query("bootstrap_ci")
def _(spark, sf_dir):
    j = judged(spark, sf_dir).select("doc_id", (F.col("truth") == F.col("predicted")).cast("double").alias("rule"), (F.col("truth") == "1").cast("double").alias("majority"))
    return metrics.paired_bootstrap(j, "rule", "majority")
