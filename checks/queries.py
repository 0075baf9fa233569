"""Registered queries: whole tables in, one result frame out.

Arrays and structs are shown as text and doubles are rounded, so that results
of two engines compare.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import (
    all_tickets,
    document_tickets,
    fix_parts,
    fix_rows,
    json_lines,
    table,
)
from ticketloom.functions.fields import flatten_json, parse_json, typed_fields
from ticketloom.functions.text import is_blank
from ticketloom.operators import dedupe, enrich, lengths, profile, quality, repair, synth, validate
from ticketloom.operators.fixes import merge_fixes, pair_fixes
from ticketloom.plans import build
from ticketloom.session import prepare, stage, stage_path
from ticketloom.sources import lines, tables
from ticketloom.sources.taxonomy import allowed_paths, built_in_remap, built_in_taxonomy

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(prepare(spark), sf_dir)

    REGISTRY[run.__name__] = prepared
    return run


def joined(name: str, separator: str = "|") -> Column:
    return F.array_join(name, separator).alias(name)


def labels_text() -> Column:
    labels = F.col("labels_json")
    return F.concat_ws(
        "|", labels["l1"], labels["l2"], labels["l3"], F.array_join(labels["tags"], ";")
    ).alias("labels_json")


def flat(df: DataFrame) -> DataFrame:
    """Ticket columns with tags and labels as text."""
    shown = {"tags": joined("tags"), "labels_json": labels_text()}
    return df.select(*[shown.get(c, F.col(c)) for c in df.columns])


def rounded(df: DataFrame, *names: str, places: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), places) for n in names})


def reason_text() -> Column:
    return F.array_join("reason", ",").alias("reason")


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate(document_tickets(spark, sf_dir), built_in_taxonomy(spark))


# --- validation of typed tickets ---------------------------------------------


@query
def validate_codes(spark, sf_dir):
    """Rows per error code, before duplicates and repair."""
    tickets = document_tickets(spark, sf_dir)
    return validate.code_counts(
        validate.check_rows(tickets, built_in_taxonomy(spark), typed_fields())
    )


@query
def validate_reasons(spark, sf_dir):
    return validated(spark, sf_dir).select("pos", "ticket_id", reason_text())


@query
def clean_rows(spark, sf_dir):
    return flat(validate.accepted_rows(validated(spark, sf_dir)))


@query
def rejected_rows(spark, sf_dir):
    rejected = validate.rejected_rows(validated(spark, sf_dir))
    return rejected.select("pos", "ticket_id", "description_ar", "priority", reason_text())


@query
def autofixed_priority(spark, sf_dir):
    rows = validated(spark, sf_dir)
    before = rows.where("autofix").select("pos", F.col("priority").alias("old_priority"))
    after = validate.accepted_rows(rows).select("pos", "ticket_id", "priority")
    return after.join(before, "pos")


@query
def duplicate_ids(spark, sf_dir):
    rows = validated(spark, sf_dir)
    return rows.where(F.array_contains("reason", validate.DUPLICATE_ID)).select("pos", "ticket_id")


@query
def run_summary(spark, sf_dir):
    return validate.run_summary(validated(spark, sf_dir))


@query
def rejected_listing(spark, sf_dir):
    rejected = validate.rejected_rows(validated(spark, sf_dir))
    placed = rejected.withColumns({"source": F.lit("documents"), "line": F.col("pos")})
    return validate.rejected_listing(placed)


@query
def strict_contract(spark, sf_dir):
    """Strict profile on tickets with fewer tags, odd ids and dates without a zone."""
    i = F.col("pos")
    tickets = document_tickets(spark, sf_dir).withColumns(
        {
            "tags": F.slice("tags", 1, (1 + i % 4).cast("int")),
            "ticket_id": F.when(i % 17 == 0, F.translate("ticket_id", "-", "_")).otherwise(F.col("ticket_id")),
            "created_at": F.when(i % 13 == 0, F.substring_index("created_at", "T", 1)).otherwise(F.col("created_at")),
        }
    )
    rows = validate.validate(tickets, built_in_taxonomy(spark), "strict")
    return rows.select("pos", "ticket_id", reason_text())


@query
def canonical_columns(spark, sf_dir):
    return flat(tables.project(all_tickets(spark, sf_dir)))


@query
def preview_head(spark, sf_dir):
    return flat(profile.preview(document_tickets(spark, sf_dir)))


@query
def taxonomy_coverage(spark, sf_dir):
    """Every leaf with its tags and its tickets."""
    counts = all_tickets(spark, sf_dir).groupBy("category_path").agg(F.count("*").alias("n"))
    leaves = built_in_taxonomy(spark).withColumn("tags", F.array_join("tags", ","))
    return leaves.join(counts.withColumnRenamed("category_path", "path"), "path", "left").select(
        "k", "l1", "l2", "l3", "path", "tags", F.coalesce("n", F.lit(0)).alias("n")
    )


@query
def allowed_paths_used(spark, sf_dir):
    """Allowed paths that occur in the tickets."""
    used = document_tickets(spark, sf_dir).select(F.col("category_path").alias("path"))
    return allowed_paths(built_in_taxonomy(spark)).join(used, "path", "left_semi")


# --- raw JSON lines ----------------------------------------------------------


def validated_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = build.checked_lines(json_lines(spark, sf_dir), built_in_taxonomy(spark), "code")
    return validate.resolve(stage(checked, "checked"))


@query
def json_reasons(spark, sf_dir):
    """Codes of raw lines: parse errors, missing keys, wrong JSON types, duplicates."""
    return validated_json(spark, sf_dir).select("pos", "ticket_id", "parse_ok", reason_text())


@query
def json_clean_rows(spark, sf_dir):
    """Clean JSON text read back as typed columns."""
    clean = build.clean_json(validated_json(spark, sf_dir)).select(F.col("json").alias("raw"))
    return flat(build.typed_lines(clean))


@query
def json_quality(spark, sf_dir):
    """Violation counts over raw lines, unparseable ones included in the total."""
    rows = flatten_json(parse_json(json_lines(spark, sf_dir)), ["pos"])
    return quality.violations(rows, built_in_taxonomy(spark))


@query
def json_reject_listing(spark, sf_dir):
    """Reject lines written, read back and unwrapped."""
    rejected = build.rejected(validated_json(spark, sf_dir))
    path = stage_path(spark, "rejects")
    tables.write_rejects(rejected, path)
    lines_back = spark.read.text(path).withColumnRenamed("value", "raw")
    parsed = parse_json(lines_back)
    member = "try_variant_get(parsed, '$.{}', '{}')"
    return parsed.select(
        F.expr(member.format("source", "string")).alias("source"),
        F.expr(member.format("line", "bigint")).alias("line"),
        F.array_join(F.expr(member.format("reason", "array<string>")), ",").alias("reason"),
        F.expr(member.format("ticket.description_ar", "string")).alias("description_ar"),
        F.expr(member.format("raw", "string")).isNotNull().alias("has_raw"),
    )


@query
def parse_props(spark, sf_dir):
    """Event properties through the JSON parser."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("raw"))
    parsed = parse_json(events)
    return parsed.select(
        "event_id",
        "parse_ok",
        F.array_join("keys", ",").alias("keys"),
        F.expr("try_variant_get(parsed, '$.k', 'bigint')").alias("k"),
    )


# --- files -------------------------------------------------------------------


@query
def scan_line_numbers(spark, sf_dir):
    """Lines written in document order and scanned again: numbers that are off."""
    path = stage_path(spark, "parts")
    ordered = (
        json_lines(spark, sf_dir)
        .select("pos", F.concat(F.col("pos").cast("string"), F.lit("\t"), "raw").alias("value"))
        .repartitionByRange("pos")
        .sortWithinPartitions("pos")
    )
    ordered.select("value").write.text(path)
    parts = lines.read_parts(spark, path).withColumn(
        "doc_id", F.substring_index("raw", "\t", 1).cast("bigint")
    )
    per_file = parts.groupBy("source").agg(
        F.count("*").alias("n"), F.min("line").alias("first"), F.max("line").alias("last")
    )
    sizes = per_file.agg(
        F.sum("n").alias("n_rows"),
        F.count_if((F.col("first") != 1) | (F.col("last") != F.col("n"))).alias("files_off"),
    )
    following = parts.select("source", (F.col("line") - 1).alias("line"), F.col("doc_id").alias("next_id"))
    out_of_order = (
        parts.select("source", "line", "doc_id")
        .join(following, ["source", "line"])
        .where("next_id <= doc_id")
        .agg(F.count("*"))
    )
    return sizes.withColumn("pairs_off", out_of_order.scalar())


@query
def csv_roundtrip(spark, sf_dir):
    path = stage_path(spark, "csv")
    tables.write_csv(all_tickets(spark, sf_dir), path)
    return tables.read_csv(spark, path)


@query
def jsonl_roundtrip(spark, sf_dir):
    path = stage_path(spark, "jsonl")
    tables.write_jsonl(tables.project(all_tickets(spark, sf_dir)), path)
    return flat(tables.read_jsonl(spark, path))


# --- fix merge and repair ----------------------------------------------------


@query
def fix_merge(spark, sf_dir):
    parts, fixes = fix_parts(spark, sf_dir), fix_rows(spark, sf_dir)
    paired, _ = pair_fixes(parts, fixes)
    return merge_fixes(parts, paired, ["text", "origin"])


@query
def fix_version(spark, sf_dir):
    """The merged parts written as a new version and scanned: order and texts."""
    parts, fixes = fix_parts(spark, sf_dir), fix_rows(spark, sf_dir)
    paired, _ = pair_fixes(parts, fixes)
    merged = merge_fixes(parts, paired, ["text", "origin"])
    rows = merged.select("part", "line", F.to_json(F.struct("line", "text", "origin")).alias("raw"))
    path = stage_path(spark, "version")
    tables.write_version(rows, path)
    back = parse_json(lines.read_parts(spark, f"{path}/*"))
    member = "try_variant_get(parsed, '$.{}', '{}')"
    return back.select(
        F.regexp_extract("source", "part=([^/]+)/", 1).alias("part"),
        F.expr(member.format("line", "bigint")).alias("line"),
        F.expr(member.format("text", "string")).alias("text"),
        F.expr(member.format("origin", "string")).alias("origin"),
    )


@query
def fix_orphans(spark, sf_dir):
    _, orphans = pair_fixes(fix_parts(spark, sf_dir), fix_rows(spark, sf_dir))
    return orphans.select("part", "line", "id_key", "origin")


def repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = validate.rejected_rows(validated(spark, sf_dir))
    placed = rejected.withColumns({"source": F.lit("documents"), "line": F.col("pos")})
    return repair.repair(placed, built_in_taxonomy(spark))


@query
def repair_rules(spark, sf_dir):
    return flat(repaired(spark, sf_dir))


@query
def repair_revalidated(spark, sf_dir):
    """What the validator says of repaired rows: only ids that are still taken."""
    rows = repaired(spark, sf_dir).withColumn("pos", F.col("line"))
    again = validate.validate(rows, built_in_taxonomy(spark), "strict")
    return again.groupBy(reason_text()).agg(F.count("*").alias("n"))


@query
def repair_json_rejects(spark, sf_dir):
    """Reject lines, wrapped and bare, repaired: one row each, made-up ids included."""
    rejected = build.rejected(validated_json(spark, sf_dir))
    wrapped = F.concat(F.lit('{"reason":["x"],"ticket":'), "raw", F.lit("}"))
    bare = F.col("line") % 2 == 0
    lines_in = rejected.select("source", "line", F.when(bare, F.col("raw")).otherwise(wrapped).alias("raw"))
    return flat(repair.repair_lines(lines_in, built_in_taxonomy(spark)))


@query
def repair_free_ids(spark, sf_dir):
    """Made-up ids where every other one is in use already, and one of those too."""
    lines_in = build.rejected(validated_json(spark, sf_dir)).select("source", "line", "raw")
    place = F.concat_ws(":", "source", "line")
    number = F.conv(F.substring(F.sha2(F.concat(place, F.col("tail")), 256), 1, 15), 16, 10)
    planted = F.when(F.col("line") % 2 == 0, F.array(F.lit(""))).otherwise(F.array()).cast("array<string>")
    planted = F.when(F.col("line") % 4 == 0, F.array(F.lit(""), F.lit("#1"))).otherwise(planted)
    taken = lines_in.withColumn("tail", F.explode(planted)).select(F.concat(F.lit("TCKT-"), number).alias("ticket_id"))
    return repair.repair_lines(lines_in, built_in_taxonomy(spark), taken).select("line", "ticket_id")


# --- quality report ----------------------------------------------------------


@query
def dq_violations(spark, sf_dir):
    return quality.violations(document_tickets(spark, sf_dir), built_in_taxonomy(spark))


@query
def dq_first10_priority(spark, sf_dir):
    return quality.first_priority_mismatches(document_tickets(spark, sf_dir))


@query
def dq_first10_taxonomy(spark, sf_dir):
    tickets = document_tickets(spark, sf_dir)
    return quality.first_taxonomy_violations(tickets, built_in_taxonomy(spark))


@query
def dq_lengths(spark, sf_dir):
    return rounded(quality.lengths(all_tickets(spark, sf_dir)), "mean", "median")


@query
def dq_top10_hier(spark, sf_dir):
    return quality.top_keys(quality.hierarchy_counts(all_tickets(spark, sf_dir)))


@query
def dq_top10_scalar(spark, sf_dir):
    return quality.top_keys(quality.scalar_counts(all_tickets(spark, sf_dir)))


@query
def dq_duplicates(spark, sf_dir):
    return quality.duplicates(all_tickets(spark, sf_dir))


@query
def dq_report_text(spark, sf_dir):
    return quality.report(document_tickets(spark, sf_dir), built_in_taxonomy(spark))


# --- duplicates --------------------------------------------------------------


@query
def duplicate_groups(spark, sf_dir):
    groups = dedupe.duplicate_groups(document_tickets(spark, sf_dir))
    return groups.select("first_pos", "copies")


@query
def drop_duplicates_first(spark, sf_dir):
    kept = dedupe.drop_duplicates(document_tickets(spark, sf_dir))
    return kept.select("pos", "ticket_id", "title_ar", "description_ar")


@query
def vary_duplicates(spark, sf_dir):
    varied = dedupe.vary_duplicates(document_tickets(spark, sf_dir))
    return varied.select("pos", "ticket_id", "description_ar")


@query
def vary_duplicates_by_sum(spark, sf_dir):
    varied = dedupe.vary_duplicates(document_tickets(spark, sf_dir), mode="sum")
    return varied.select("pos", "ticket_id", "description_ar")


@query
def residual_duplicates(spark, sf_dir):
    return dedupe.residual_duplicates(dedupe.vary_duplicates(document_tickets(spark, sf_dir)))


@query
def vary_duplicates_numbered(spark, sf_dir):
    varied = dedupe.vary_duplicates(document_tickets(spark, sf_dir), mode="numbered")
    return varied.select("pos", "ticket_id", "description_ar")


@query
def residual_numbered(spark, sf_dir):
    return dedupe.residual_duplicates(dedupe.vary_duplicates(document_tickets(spark, sf_dir), mode="numbered"))


# --- post-processing ---------------------------------------------------------


@query
def postprocess_remap(spark, sf_dir):
    mapped = enrich.remap_leaves(all_tickets(spark, sf_dir), built_in_remap(spark))
    columns = ["pos", "ticket_id", *enrich.LEVELS, "category_path", "labels_json"]
    return flat(mapped.select(*columns, "tags"))


@query
def postprocess_priority(spark, sf_dir):
    return enrich.recompute_priority(all_tickets(spark, sf_dir)).select(
        "pos", "ticket_id", "impact", "urgency", "priority"
    )


@query
def postprocess_enrich(spark, sf_dir):
    done = enrich.postprocess(all_tickets(spark, sf_dir), built_in_remap(spark))
    return flat(done)


# --- synthesis ---------------------------------------------------------------


def synthesized(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("seq"))
    return synth.synthesize(seqs, built_in_taxonomy(spark))


@query
def synthesize_rows(spark, sf_dir):
    """One synthetic ticket per document."""
    return flat(synthesized(spark, sf_dir))


@query
def synthesize_checked(spark, sf_dir):
    """The validator's view of synthetic tickets."""
    rows = validate.validate(synthesized(spark, sf_dir), built_in_taxonomy(spark), "strict")
    return validate.run_summary(rows)


# --- profile -----------------------------------------------------------------


@query
def overview(spark, sf_dir):
    return profile.overview(document_tickets(spark, sf_dir))


@query
def missing_by_column(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return profile.missing_by_column(docs.join(labels, "doc_id", "left"))


def register_counts(name: str, col: str, source: Callable = document_tickets) -> None:
    def run(spark, sf_dir):
        return profile.value_counts(source(spark, sf_dir), col)

    run.__name__ = f"value_counts_{name}"
    query(run)


def register_keyed(name: str, source: Callable = document_tickets) -> None:
    def run(spark, sf_dir):
        return profile.value_counts_by_key(source(spark, sf_dir), name)

    run.__name__ = f"value_counts_{name}"
    query(run)


def register_shares(name: str, col: str) -> None:
    def run(spark, sf_dir):
        return profile.class_shares(document_tickets(spark, sf_dir), col)

    run.__name__ = f"class_shares_{name}"
    query(run)


def of(name: str) -> Callable:
    return lambda spark, sf_dir: table(spark, sf_dir, name)


for level in (1, 2, 3):
    register_counts(f"l{level}", f"category_level_{level}")
for column in ("sentiment", "channel", "dialect"):
    register_counts(column, column)
for column in ("priority", "urgency", "impact"):
    register_keyed(column)
register_counts("order_status", "o_orderstatus", of("orders"))
register_counts("role", "role", of("conversations"))
register_shares("l1", "category_level_1")
register_shares("sentiment", "sentiment")


@query
def class_balance(spark, sf_dir):
    balance = profile.class_balance(document_tickets(spark, sf_dir))
    return rounded(balance, "mean_size", "std_size", "imbalance_ratio")


@query
def crosstab_sentiment(spark, sf_dir):
    return profile.crosstab(document_tickets(spark, sf_dir), "category_level_1", "sentiment")


@query
def crosstab_dialect(spark, sf_dir):
    return profile.crosstab(document_tickets(spark, sf_dir), "category_level_1", "dialect")


TEXT_FIELDS = ["title_ar", "description_ar"]


def field_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.text_lengths(document_tickets(spark, sf_dir), TEXT_FIELDS)


@query
def length_columns(spark, sf_dir):
    return document_tickets(spark, sf_dir).select(
        "pos",
        F.length("title_ar").alias("title_len"),
        F.length("description_ar").alias("desc_len"),
        is_blank(F.col("description_ar")).alias("desc_blank"),
    )


@query
def length_hist(spark, sf_dir):
    return rounded(lengths.histogram(field_lengths(spark, sf_dir), ["field"]), "bin_low", "bin_high")


@query
def length_kde(spark, sf_dir):
    curve = lengths.density_curve(field_lengths(spark, sf_dir), ["field"])
    return rounded(curve, "point", "height")


@query
def length_stats(spark, sf_dir):
    stats = lengths.length_stats(all_tickets(spark, sf_dir), TEXT_FIELDS)
    return rounded(stats, "mean", "median")


def lengths_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    tickets = document_tickets(spark, sf_dir)
    return lengths.value_frequencies(tickets, F.length("description_ar"), ["category_level_1"])


@query
def median_by_class(spark, sf_dir):
    return rounded(lengths.medians(lengths_by_class(spark, sf_dir), "category_level_1"), "median")


BOX = ["whisker_low", "q1", "median", "q3", "whisker_high"]


@query
def box_by_class(spark, sf_dir):
    box = lengths.box_stats(lengths_by_class(spark, sf_dir), "category_level_1")
    return rounded(box, *BOX)


@query
def box_quantity(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    freq = lengths.value_frequencies(items, F.col("l_quantity"), ["l_returnflag"])
    return rounded(lengths.box_stats(freq, "l_returnflag"), *BOX)


@query
def box_price(spark, sf_dir):
    """Box statistics of a column with about as many values as rows."""
    items = table(spark, sf_dir, "lineitem")
    freq = lengths.value_frequencies(items, F.col("l_extendedprice"), ["l_returnflag"])
    return rounded(lengths.box_stats(freq, "l_returnflag"), *BOX)


@query
def profile_all(spark, sf_dir):
    """Counts of every table of a profile as (table, key, n)."""
    tables_of = profile.profile(document_tickets(spark, sf_dir))
    shown = {name: ("value", "n") for name in tables_of if name.startswith(("counts_", "shares_"))}
    shown |= {"overview": ("metric", "value"), "missing": ("column", "n_missing"), "balance": ("level", "classes"),
              "length_boxes": ("category_level_1", "n_outliers"), "duplicates": ("check", "n"), "tags": ("tag", "n"),
              "length_stats": ("field", "max"), "length_histogram": ("bin", "n"), "preview": ("ticket_id", "pos"), "sample": ("ticket_id", "length(title_ar)")}
    parts = [
        tables_of[name].select(F.lit(name).alias("table"), F.col(key).cast("string").alias("key"), F.expr(n).cast("bigint").alias("n"))
        for name, (key, n) in shown.items()
    ]
    for name in ("crosstab_sentiment", "crosstab_dialect"):
        wide = tables_of[name]
        long = wide.unpivot(["category_level_1"], wide.columns[1:], "other", "n")
        parts.append(long.select(F.lit(name).alias("table"), F.concat_ws("/", "category_level_1", "other").alias("key"), F.col("n").cast("bigint").alias("n")))
    return reduce(DataFrame.unionByName, parts)


@query
def duplicate_membership(spark, sf_dir):
    return profile.duplicate_membership(document_tickets(spark, sf_dir))


@query
def tag_top20(spark, sf_dir):
    return profile.top_tags(all_tickets(spark, sf_dir))


@query
def type_word_top20(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.split("p_type", " ").alias("tags"))
    return profile.top_tags(parts)


@query
def tag_parse(spark, sf_dir):
    """Lists written as text in two spellings, and texts that are no list."""
    docs = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    written = (
        F.when(i % 3 == 0, F.concat(F.lit('["'), "lang", F.lit('", "'), "source", F.lit('"]')))
        .when(i % 3 == 1, F.concat(F.lit("['"), "lang", F.lit("']")))
        .otherwise(F.col("source"))
    )
    named = docs.select("doc_id", written.alias("tags"))
    parsed = profile.parse_tags(named)
    return named.select(
        "doc_id", F.array_join(parsed, "|").alias("tags"), F.size(parsed).alias("n_tags")
    )


@query
def sample8(spark, sf_dir):
    return profile.sample_rows(document_tickets(spark, sf_dir))


from checks import file_queries  # noqa: E402, F401  registers the file plans
