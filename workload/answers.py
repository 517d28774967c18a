"""Cleaning, matching and unpivoting of answers."""

import uuid

from pyspark.sql import functions as F

from tally.functions import (
    bracket_base,
    bracket_suffix,
    clean_single,
    first_semver,
    keep_values,
    map_values,
    map_values_join,
    normalize_text,
    ordinal_rank,
    rank_position,
    string_array,
    yes_no,
)
from tally.operators import counts_single
from tally.sources import (
    Survey,
    attach_commentary,
    catalog_faults,
    choice_mismatches,
    header_forms,
    match_headers,
    missing_questions,
    question_catalog,
    read_responses,
    rows_without_commentary,
    split_sections,
)
from tally.storage import shared_folder
from workload.registry import query, table


@query(
    "clean_single",
    """
    SELECT conv_id, turn, side, md5(CASE WHEN t = '' THEN 'Skipped' ELSE t END) AS answer
    FROM (SELECT conv_id, turn, 'padded' AS side,
                 trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) AS t FROM conversations
          UNION ALL SELECT conv_id, turn, 'blank', '' FROM conversations)
    """,
)
def cleaned(spark, d):
    """Every text with white space around it, and a blank answer beside it."""
    sides = F.array(
        F.struct(F.lit("padded").alias("side"), F.concat(F.lit("\t "), "text", F.lit(" \r\n")).alias("value")),
        F.struct(F.lit("blank").alias("side"), F.lit(" \t\r\n").alias("value")),
    )
    turns = table(spark, d, "conversations").select("conv_id", "turn", F.inline(sides))
    return turns.select("conv_id", "turn", "side", F.md5(clean_single(F.col("value"))).alias("answer"))


@query(
    "normalize_yes_no",
    """
    SELECT l_returnflag || l_linestatus AS answers,
           CASE l_returnflag WHEN 'R' THEN 'Yes' WHEN 'N' THEN 'No' ELSE 'Other' END AS label,
           count(*) AS n
    FROM lineitem GROUP BY 1, 2
    """,
)
def yes_or_no(spark, d):
    flag = F.concat(F.lit(" "), "l_returnflag")
    label = yes_no(flag, yes_aliases={"r"}, no_aliases={"n"})
    lines = table(spark, d, "lineitem")
    return lines.groupBy(
        F.concat("l_returnflag", "l_linestatus").alias("answers"), label.alias("label")
    ).agg(F.count(F.lit(1)).alias("n"))


def _semver_sql(key: str, column: str, source: str) -> str:
    """Runs of dotted numbers, split at the dots: the first three neighbours without leading zeros."""
    plain = "regexp_full_match({0}, '0|[1-9][0-9]*')"
    sound = " AND ".join(plain.format(f"p[i + {k}]") for k in range(3))
    triples = (
        f"list_transform(list_filter(range(1, len(p) - 1), lambda i: {sound}), "
        "lambda i: p[i] || '.' || p[i + 1] || '.' || p[i + 2])"
    )
    return f"""
    SELECT {key}, CASE WHEN trim({column}, ' ' || chr(9) || chr(10) || chr(13)) = '' OR {column} IS NULL THEN 'Skipped'
           ELSE coalesce(list_extract(flatten(list_transform(
               list_transform(regexp_extract_all({column}, '[0-9]+([.][0-9]+)+'), lambda r: string_split(r, '.')),
               lambda p: {triples})), 1), 'No Match') END AS version
    FROM {source}
    """


@query(
    "normalize_yes_no_defaults",
    """
    SELECT l_returnflag || l_linestatus AS answers,
           CASE WHEN l_returnflag = 'R' THEN 'Yes' WHEN l_returnflag = 'N' THEN 'No'
                WHEN l_linestatus = 'F' THEN 'Skipped' ELSE 'Other' END AS label, count(*) AS n
    FROM lineitem GROUP BY 1, 2
    """,
)
def yes_or_no_by_default(spark, d):
    lines = table(spark, d, "lineitem")
    said = (
        F.when(F.col("l_returnflag") == "R", F.lit(" YEP\n"))
        .when(F.col("l_returnflag") == "N", F.lit("nope "))
        .when(F.col("l_linestatus") == "F", F.lit(" \t"))
        .otherwise(F.lit("perhaps"))
    )
    return lines.groupBy(
        F.concat("l_returnflag", "l_linestatus").alias("answers"), yes_no(said).alias("label")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("extract_semver_documents", _semver_sql("doc_id", "text", "documents"))
def document_versions(spark, d):
    return table(spark, d, "documents").select("doc_id", first_semver(F.col("text")).alias("version"))


@query("extract_semver_pages", _semver_sql("page_id", "html", "pages"))
def page_versions(spark, d):
    return table(spark, d, "pages").select("page_id", first_semver(F.col("html")).alias("version"))


@query(
    "semver_counts",
    f"""
    WITH v AS ({_semver_sql("doc_id", "text", "documents")}),
    c AS (SELECT version AS label, count(*) AS n FROM v GROUP BY 1),
    f AS (SELECT *, n / (SELECT count(*) FROM v) * 100.0::DOUBLE < 0.1 OR n < 5 AS rare FROM c),
    b AS (SELECT label, n FROM f WHERE NOT rare UNION ALL
          SELECT 'Other (combined)', CAST(sum(n) AS BIGINT) FROM f WHERE rare HAVING count(*) > 0)
    SELECT row_number() OVER (ORDER BY n DESC, label) AS pos, label, n AS count,
           n / (SELECT count(*) FROM v) * 100.0::DOUBLE AS percent
    FROM b
    """,
)
def version_counts(spark, d):
    return counts_single(table(spark, d, "documents"), first_semver(F.col("text")), min_percent=0.1)


# The pages use these references only, &amp also without its semicolon; & is decoded
# last so that nothing decodes twice.
_DECODED = """regexp_replace(replace(replace(replace(replace(
    regexp_replace(html, '\\s+', ' ', 'g'), '""', '"'),
    '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&amp;?', '&', 'g')"""


@query(
    "normalize_text",
    f"""
    SELECT page_id, md5(trim(regexp_replace(replace({_DECODED}, ' - ', ' '), '\\s+', ' ', 'g')))
           AS digest
    FROM pages
    """,
)
def normalized_pages(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id", F.md5(normalize_text(F.col("html"))).alias("digest"))


@query(
    "split_bracket_suffix",
    """
    SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN p_name || ' [x] ' || p_type ELSE
               p_name || CASE WHEN p_size % 2 = 0 THEN ' [old]' ELSE '' END END AS base,
           CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END AS suffix
    FROM part
    """,
)
def bracketed(spark, d):
    header = F.when(
        F.col("p_size") % 5 == 0, F.concat("p_name", F.lit(" [x] "), "p_type")
    ).otherwise(
        F.concat(
            "p_name",
            F.when(F.col("p_size") % 2 == 0, F.lit(" [old]")).otherwise(F.lit("")),
            F.lit(" [ "),
            "p_brand",
            F.lit(" ]\n"),
        )
    )
    parts = table(spark, d, "part").withColumn("header", header)
    return parts.select(
        "p_partkey",
        bracket_base(F.col("header")).alias("base"),
        bracket_suffix(F.col("header")).alias("suffix"),
    )


@query(
    "match_rank_positions",
    """
    SELECT CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linenumber END AS position, count(*) AS n
    FROM lineitem GROUP BY 1
    """,
)
def rank_positions(spark, d):
    label = F.when(F.col("l_returnflag") == "N", F.lit("Place ")).otherwise(F.lit("Rank "))
    suffix = F.concat(label, F.col("l_linenumber").cast("string"))
    lines = table(spark, d, "lineitem")
    return lines.groupBy(rank_position(suffix).alias("position")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "exclude_values",
    """
    SELECT o_orderstatus AS status, count(*) AS n FROM orders
    WHERE o_orderpriority NOT IN ('5-LOW', '1-URGENT') GROUP BY 1
    """,
)
def excluded(spark, d):
    kept = keep_values(table(spark, d, "orders"), F.col("o_orderpriority"), ["5-LOW", "1-URGENT"])
    return kept.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "map_values",
    """
    SELECT CASE p_type WHEN 'SMALL' THEN 'Basic' WHEN 'ECONOMY' THEN 'Basic'
                WHEN 'PROMO' THEN 'Special' ELSE p_type END AS band, count(*) AS n
    FROM part GROUP BY 1
    """,
)
def mapped(spark, d):
    bands = {"SMALL": "Basic", "ECONOMY": "Basic", "PROMO": "Special"}
    band = map_values(F.col("p_type"), bands)
    return table(spark, d, "part").groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "map_values_join",
    """
    SELECT coalesce(r_name, CAST(c_nationkey AS VARCHAR)) AS band, count(*) AS n
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 2 = 0
    LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY 1
    """,
)
def mapped_by_table(spark, d):
    nations = table(spark, d, "nation").filter(F.col("n_nationkey") % 2 == 0)
    mapping = nations.join(
        table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").cast("string").alias("key"), "r_name")
    customers = table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("band"))
    banded = map_values_join(customers, "band", mapping, key="key", label="r_name")
    return banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ordinal_rank",
    """
    SELECT o_orderpriority AS label,
           CAST(coalesce(list_position(['5-LOW', '3-MEDIUM', '1-URGENT'], o_orderpriority) - 1, 3)
                AS BIGINT) AS rank, count(*) AS n
    FROM orders GROUP BY 1, 2
    """,
)
def ranked_values(spark, d):
    order = string_array(["5-LOW", "3-MEDIUM", "1-URGENT"])
    counted = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.withColumn("rank", ordinal_rank(F.col("label"), order))


@query(
    "unpivot_responses",
    """
    SELECT question_id, kind, choice, choice_pos, value, count(*) AS n FROM (
        SELECT 'segment' AS question_id, 'single' AS kind, NULL AS choice,
               CAST(NULL AS INTEGER) AS choice_pos, c_mktsegment AS value FROM customer
        UNION ALL SELECT 'sign', 'multiple', 'Debt', 1, 'Yes' FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 'sign', 'multiple', 'Rich', 2, 'Yes' FROM customer WHERE c_acctbal > 5000
        UNION ALL SELECT 'rank', 'ranking', NULL, 1, c_mktsegment FROM customer
        UNION ALL SELECT 'rank', 'ranking', NULL, 2, 'NATION' FROM customer WHERE c_nationkey > 9)
    GROUP BY ALL
    """,
)
def unpivoted(spark, d):
    def flag(condition):
        return F.when(condition, F.lit("Yes")).otherwise(F.lit("No"))

    wide = table(spark, d, "customer").select(
        F.col("c_custkey").alias("respondent_id"),
        F.col("c_mktsegment").alias("f0"),
        flag(F.col("c_acctbal") < 0).alias("f1"),
        flag(F.col("c_acctbal") > 5000).alias("f2"),
        F.when(F.col("c_nationkey") > 9, F.lit("NATION")).otherwise(F.lit("")).alias("f3"),
    )
    bindings = {
        "segment": {"type": "single", "prompt": "", "fields": 0},
        "sign": {"type": "multiple", "prompt": "", "fields": {"Debt": 1, "Rich": 2}},
        "rank": {"type": "ranking", "prompt": "", "fields": [0, 3]},
    }
    answers = Survey(wide, bindings).long_answers()
    keys = ["question_id", "kind", "choice", "choice_pos", "value"]
    return answers.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def part_headers(spark, d):
    """Header frame made from parts: ``"Which <type>?  [<brand>]"``, and one plain header."""
    parts = table(spark, d, "part")
    choice = parts.select(
        F.col("p_partkey").cast("int").alias("pos"),
        F.concat(
            F.lit("Which "), "p_type", F.lit("?  ["), "p_brand", F.lit(" &amp; co]")
        ).alias("raw"),
    )
    plain = parts.select(
        (-F.col("p_partkey") - 1).cast("int").alias("pos"),
        F.concat(F.lit(" About ""the"" "), "p_type", F.lit("\n")).alias("raw"),
    )
    return header_forms(choice.unionByName(plain))


def part_catalog(spark, d):
    """Questions made from the part types; a PROMO question that no header asks for."""
    parts = table(spark, d, "part")
    # Brands per type: a set of at most the distinct brands.
    multi = parts.groupBy("p_type").agg(F.sort_array(F.collect_set("p_brand")).alias("brands"))
    kinds = F.array(F.lit("multiple"), F.lit("single"))
    prompt = F.when(
        F.col("type") == "multiple", F.concat(F.lit("Which "), "p_type", F.lit("?"))
    ).otherwise(F.concat(F.lit("About the "), "p_type"))
    questions = multi.select("p_type", "brands", F.explode(kinds).alias("type"))
    choices = F.concat(
        F.transform("brands", lambda b: F.concat(b, F.lit(" & co"))), F.array(F.lit("None"))
    )
    return questions.select(
        F.concat(F.lower("p_type"), F.lit("_"), "type").alias("question_id"),
        F.hash("p_type").alias("position"),
        F.when((F.col("p_type") == "PROMO") & (F.col("type") == "single"), F.lit("Else?"))
        .otherwise(prompt)
        .alias("norm_prompt"),
        "type",
        F.when(F.col("type") == "multiple", choices).alias("choices"),
    )


@query(
    "match_headers",
    """
    SELECT lower(p_type) || '_multiple' AS question_id, 'multiple' AS type,
           p_brand || ' & co' AS suffix, CAST(max(p_partkey) AS INTEGER) AS pos FROM part GROUP BY 1, 2, 3
    UNION ALL
    SELECT lower(p_type) || '_single', 'single', NULL, CAST(max(-p_partkey - 1) AS INTEGER) FROM part
    WHERE p_type <> 'PROMO' GROUP BY 1
    """,
)
def matched(spark, d):
    found = match_headers(part_headers(spark, d), part_catalog(spark, d))
    return found.select("question_id", "type", "suffix", "pos")


@query(
    "missing_questions",
    "SELECT 'doc_' || doc_id AS question_id, 'single' AS type FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def missing(spark, d):
    """A question for each document; the labels bring the columns."""
    prompt = F.concat(F.lit("How good is "), F.col("doc_id").cast("string"), F.lit("?"))
    catalog = table(spark, d, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("question_id"),
        F.col("doc_id").cast("int").alias("position"),
        prompt.alias("norm_prompt"),
        F.lit("single").alias("type"),
        F.lit(None).cast("array<string>").alias("choices"),
    )
    labels = table(spark, d, "labels")
    headers = labels.select(F.col("doc_id").cast("int").alias("pos"), F.concat(F.lit(" "), prompt).alias("raw"))
    return missing_questions(catalog, match_headers(header_forms(headers), catalog)).select("question_id", "type")


_BALANCES = """
    WITH declared AS (SELECT DISTINCT 'nation_' || c_nationkey AS q, CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS choice
                      FROM customer),
    present AS (SELECT DISTINCT 'nation_' || s_nationkey AS q, CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) AS choice
                FROM supplier)
"""


@query(
    "choice_mismatches",
    f"""
    {_BALANCES}
    SELECT q AS question_id, 'columns' AS side, choice FROM (FROM present EXCEPT FROM declared)
    WHERE q IN (SELECT q FROM declared)
    UNION ALL SELECT q, 'declared', choice FROM (FROM declared EXCEPT FROM present)
    """,
)
def mismatched(spark, d):
    """A question for each nation: customers declare its balances, suppliers bring its columns."""
    customers, suppliers = table(spark, d, "customer"), table(spark, d, "supplier")

    def balance(column):
        return F.floor(column).cast("string")

    def prompt(key):
        return F.concat(F.lit("Balances of nation "), F.col(key).cast("string"))

    # The distinct whole balances of a nation.
    declared = customers.groupBy("c_nationkey").agg(F.collect_set(balance("c_acctbal")).alias("choices"))
    catalog = declared.select(
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("question_id"),
        F.col("c_nationkey").alias("position"), prompt("c_nationkey").alias("norm_prompt"),
        F.lit("multiple").alias("type"), "choices",
    )
    headers = suppliers.select(
        F.col("s_suppkey").cast("int").alias("pos"),
        F.concat(prompt("s_nationkey"), F.lit(" ["), balance("s_acctbal"), F.lit("]")).alias("raw"),
    )
    return choice_mismatches(catalog, match_headers(header_forms(headers), catalog))


@query(
    "read_responses",
    """
    SELECT row_number() OVER (ORDER BY c_custkey) AS respondent_id, c_name AS name, c_mktsegment AS segment,
           CASE WHEN c_acctbal < 0 THEN 'Skipped' ELSE c_mktsegment || ', "' || c_nationkey || '"' END AS note,
           c_acctbal > 5000 AS rich, c_nationkey % 2 = 0 AS even,
           CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_mktsegment END AS best
    FROM customer
    """,
)
def responses(spark, d):
    """Customers as response files, several of them, read back against a catalog and numbered by arrival."""

    def flag(condition):
        return F.when(condition, F.lit("Yes")).otherwise(F.lit("No"))

    segment = F.col("c_mktsegment")
    answers = table(spark, d, "customer").select(
        F.col("c_name").alias("Who are you?"),
        segment.alias(" Which  segment? "),
        F.when(F.col("c_acctbal") < 0, F.lit(" ")).otherwise(
            F.concat(segment, F.lit(', "'), F.col("c_nationkey").cast("string"), F.lit('"'))
        ).alias("A note?"),
        flag(F.col("c_acctbal") > 5000).alias("What fits? [rich]"),
        flag(F.col("c_nationkey") % 2 == 0).alias("What fits? [even]"),
        F.when(F.col("c_acctbal") < 1000, F.lit("")).otherwise(segment).alias("Which is best? [Rank 1]"),
        "c_custkey",
    )
    folder = f"{shared_folder(spark)}/responses-{uuid.uuid4().hex}"
    # Files in the order of the customers, a few from each range.
    ordered = answers.repartitionByRange("c_custkey").sortWithinPartitions("c_custkey").drop("c_custkey")
    ordered.write.options(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False,
                          ignoreTrailingWhiteSpace=False).csv(folder)
    catalog = question_catalog(spark, [
        {"id": "who", "prompt": "Who are you?", "type": "text"},
        {"id": "segment", "prompt": "Which segment?", "type": "single"},
        {"id": "note", "prompt": "A note?", "type": "text"},
        {"id": "fits", "prompt": "What fits?", "type": "multiple", "choices": ["even", "rich"]},
        {"id": "best", "prompt": "Which is best?", "type": "ranking"},
    ])
    survey = read_responses(spark, folder, catalog)
    fits = survey.multi("fits")
    return survey.frame.select(
        "respondent_id", survey.who.alias("name"), survey.segment.alias("segment"), survey.note.alias("note"),
        fits["rich"].alias("rich"), fits["even"].alias("even"), survey.ranking("best")[0].alias("best"),
    )


@query(
    "catalog_faults",
    """
    WITH entries AS (
        SELECT p_partkey, CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN p_brand
                               ELSE lower(p_type) || '_' || p_size END AS id,
               CASE WHEN p_retailprice > 1900 THEN 'dial' ELSE 'single' END AS type FROM part
    ),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p_partkey) AS uses FROM entries)
    SELECT CAST(p_partkey AS INTEGER) AS position, id AS question_id, fault FROM (
        SELECT *, 'it has no id' AS fault FROM numbered WHERE id IS NULL
        UNION ALL SELECT *, 'its id is no attribute name' FROM numbered WHERE contains(id, '#')
        UNION ALL SELECT *, 'its id is taken by an earlier entry' FROM numbered WHERE id IS NOT NULL AND uses > 1
        UNION ALL SELECT *, 'its type is unknown' FROM numbered WHERE type = 'dial')
    """,
)
def faulty_entries(spark, d):
    """A questionnaire with one entry for each part, checked."""
    size = F.col("p_size")
    name = F.when(size == 1, F.lit(None)).when(size == 2, F.col("p_brand")).otherwise(
        F.concat(F.lower("p_type"), F.lit("_"), size.cast("string"))
    )
    entries = table(spark, d, "part").select(
        name.alias("question_id"), F.col("p_partkey").cast("int").alias("position"), F.col("p_name").alias("prompt"),
        F.when(F.col("p_retailprice") > 1900, F.lit("dial")).otherwise(F.lit("single")).alias("type"),
        F.lit(None).cast("array<string>").alias("choices"),
    )
    return catalog_faults(entries)


@query(
    "survey_lookup",
    """
    SELECT c_custkey AS respondent_id, c_mktsegment AS segment,
           CASE WHEN o.n IS NULL THEN 'Skipped' ELSE o.first END AS note,
           coalesce(o.open, false) AS open, coalesce(o.done, false) AS done, o.first AS best, o.last AS second
    FROM customer LEFT JOIN (
        SELECT o_custkey, count(*) AS n, min(o_orderpriority) AS first, max(o_orderpriority) AS last,
               bool_or(o_orderstatus = 'O') AS open, bool_or(o_orderstatus = 'F') AS done
        FROM orders GROUP BY 1) o ON o_custkey = c_custkey
    """,
)
def looked_up(spark, d):
    """Questions of each type by id, over customers and their orders as a response file holds them."""
    status = F.col("o_orderstatus")

    def said(flag):
        return F.when(flag, F.lit("Yes")).otherwise(F.lit("No"))

    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderpriority").alias("f1"), said(F.bool_or(status == "O")).alias("f2"),
        said(F.bool_or(status == "F")).alias("f3"), F.max("o_orderpriority").alias("f4"),
    )
    wide = table(spark, d, "customer").join(orders, "c_custkey", "left").select(
        F.col("c_custkey").alias("respondent_id"), F.concat(F.lit(" "), "c_mktsegment", F.lit("\n")).alias("f0"),
        "f1", F.coalesce("f2", F.lit("No")).alias("f2"), F.coalesce("f3", F.lit("No")).alias("f3"), "f4",
    )
    survey = Survey(wide, {
        "segment": {"type": "single", "prompt": "Segment?", "fields": 0},
        "note": {"type": "text", "prompt": "Note?", "fields": 1},
        "status": {"type": "multiple", "prompt": "Status?", "fields": {"open": 2, "done": 3}},
        "urgency": {"type": "ranking", "prompt": "Urgency?", "fields": [1, 4]},
    })
    best, second = survey.ranking("urgency")
    flags = [flag.alias(choice) for choice, flag in survey.multi("status").items()]
    return survey.frame.select(
        "respondent_id", survey.segment.alias("segment"), survey["note"].alias("note"), *flags,
        best.alias("best"), second.alias("second"),
    )


def turn_sections(spark, d):
    """Each turn as sectioned text: preface, its role with the text, and a repeated section."""
    text = F.concat(
        F.lit("lost\r\n## "),
        "role",
        F.lit("\r\nold\n## tail\n### not a section\n## "),
        "role",
        F.lit("  \n\n"),
        "text",
        F.lit("\n\n##nor this"),
    )
    turns = table(spark, d, "conversations").withColumn("doc", text)
    return split_sections(turns, "doc", ["conv_id", "turn"])


@query(
    "split_sections",
    """
    SELECT conv_id, turn, 1 AS pos, role AS section_id,
           md5(trim(replace(text, chr(13) || chr(10), chr(10)), ' ' || chr(9) || chr(10) || chr(13))
               || chr(10) || chr(10) || '##nor this') AS digest
    FROM conversations
    UNION ALL
    SELECT conv_id, turn, 2, 'tail', md5('### not a section') FROM conversations
    """,
)
def sectioned(spark, d):
    return turn_sections(spark, d).select(
        "conv_id", "turn", "pos", "section_id", F.md5("body").alias("digest")
    )


def role_notes(spark, d):
    """One note per role, made of the number of its turns."""
    turns = table(spark, d, "conversations")
    return turns.groupBy(F.col("role").alias("section_id")).agg(
        F.concat(F.count(F.lit(1)).cast("string"), F.lit(" turns")).alias("body")
    )


@query(
    "attach_commentary",
    """
    SELECT conv_id, turn, role AS row_id, n || ' turns' AS commentary
    FROM conversations JOIN (SELECT role, count(*) AS n FROM conversations GROUP BY 1) USING (role)
    """,
)
def commented(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.col("role").alias("row_id"))
    return attach_commentary(rows, role_notes(spark, d))


@query(
    "rows_without_commentary",
    "SELECT doc_id, 'doc_' || doc_id AS row_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def uncommented(spark, d):
    """Documents as report rows, labels as the commentary on them."""
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))
    rows = table(spark, d, "documents").select("doc_id", name.alias("row_id"))
    return rows_without_commentary(rows, table(spark, d, "labels").select(name.alias("section_id")))
