"""Post-processing: rename leaves, recompute priority, lengthen short descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import fixed
from ticketloom.functions.picks import choose, digest_number, digit_picks
from ticketloom.functions.rules import expected_priority, joined_path
from ticketloom.functions.text import end_with_dot, text_or_empty
from ticketloom.operators.dedupe import seed_digest

LEVELS = ["category_level_1", "category_level_2", "category_level_3"]
SHORT = 90  # fixed value: descriptions below this many characters are lengthened


def remap_leaves(df: DataFrame, remap: DataFrame) -> DataFrame:
    """Rename category triples; only renamed rows get a new path and labels."""
    new = ["new_l1", "new_l2", "new_l3"]
    lookup = remap.select(
        *[F.col(f"l{n}").alias(LEVELS[n - 1]) for n in (1, 2, 3)], *new
    )
    joined = df.join(lookup, LEVELS, "left")
    renamed = F.col("new_l3").isNotNull()
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    labels = F.struct(*[F.col(n).alias(n[-2:]) for n in new], tags.alias("tags"))
    path = joined_path(*[F.col(n) for n in new])
    return joined.select(
        *[
            {
                "category_level_1": F.coalesce("new_l1", "category_level_1"),
                "category_level_2": F.coalesce("new_l2", "category_level_2"),
                "category_level_3": F.coalesce("new_l3", "category_level_3"),
                "category_path": F.when(renamed, path).otherwise(F.col("category_path")),
                "labels_json": F.when(renamed, labels).otherwise(F.col("labels_json")),
            }.get(c, F.col(c)).alias(c)
            for c in df.columns
        ]
    )


def recompute_priority(df: DataFrame) -> DataFrame:
    """Priority by rule in every row: absent inputs count 0, unusable ones leave it as is."""
    def given(name: str) -> Column:
        if "missing" not in df.columns:
            return F.col(name)
        return F.when(F.array_contains("missing", name), 0).otherwise(F.col(name))

    computed = expected_priority(given("impact"), given("urgency"))
    usable = given("impact").isNotNull() & given("urgency").isNotNull()
    return df.withColumn("priority", F.when(usable, computed).otherwise(F.col("priority")))


def detail_sentences(digest: Column) -> Column:
    """Sentences that fit the category, then the two general ones, as a list."""
    l1, l2, l3 = (F.col(c) for c in LEVELS)
    system, error, version, code, ssid, floor, signal = digit_picks(
        digest_number(digest),
        [
            len(fixed.OPERATING_SYSTEMS),
            len(fixed.VPN_ERRORS),
            len(fixed.OFFICE_VERSIONS),
            len(fixed.OUTLOOK_ERRORS),
            len(fixed.WIFI_SSIDS),
            6,
            len(fixed.WIFI_SIGNALS),
        ],
    )
    system = choose(fixed.OPERATING_SYSTEMS, system)
    version = choose(fixed.OFFICE_VERSIONS, version)
    hours, tone, _ = general_picks(digest)

    def in_l2(first: str, second: str) -> Column:
        return (l1 == first) & (l2 == second)

    outlook = in_l2("Software", "Email/Calendar") & (l3 == "Outlook Issue")
    by_category = [
        (in_l2("Network", "VPN"),
         F.format_string(fixed.VPN_SENTENCE, system, choose(fixed.VPN_ERRORS, error))),
        (outlook, F.format_string(fixed.OUTLOOK_VERSION_SENTENCE, system, version)),
        (outlook, F.lit(fixed.OUTLOOK_PROFILE_SENTENCE)),
        (outlook, F.format_string(fixed.OUTLOOK_CODE_SENTENCE, choose(fixed.OUTLOOK_ERRORS, code))),
        (in_l2("Network", "WiFi"),
         F.format_string(fixed.WIFI_SENTENCE, choose(fixed.WIFI_SSIDS, ssid), floor + 1,
                         choose(fixed.WIFI_SIGNALS, signal))),
        (in_l2("Hardware", "Laptop/Desktop") & (l3 == "Performance"),
         F.format_string(fixed.PERFORMANCE_SENTENCE, system)),
        (in_l2("Software", "Office Apps"), F.format_string(fixed.OFFICE_SENTENCE, version)),
    ]
    general = [
        F.format_string(fixed.AGE_SENTENCE, hours + 1),
        choose(fixed.TONE_SENTENCES, tone),
    ]
    return F.array_compact(F.array(*[F.when(fits, text) for fits, text in by_category], *general))


def general_picks(digest: Column) -> list[Column]:
    """Age in hours, tone, and how many sentences to add."""
    return digit_picks(digest_number(digest, 1), [48, len(fixed.TONE_SENTENCES), 3])


def lengthened(mode: str) -> Column:
    """The description and the first two to four of its detail sentences.

    The array functions keep this long expression out of the span of generated
    code around it, which would otherwise grow past what the JIT compiles.
    """
    digest = seed_digest(F.col("ticket_id"), mode)
    extra = F.slice(detail_sentences(digest), 1, (general_picks(digest)[2] + 2).cast("int"))
    base = F.rtrim(text_or_empty(F.col("description_ar")), F.lit("."))
    return F.array_join(F.transform(F.concat(F.array(base), extra), end_with_dot), " ")


def enrich_short(df: DataFrame, mode: str = "spread") -> DataFrame:
    """Add two to four sentences to descriptions under 90 characters."""
    text = text_or_empty(F.col("description_ar"))
    # characters are counted only where the bytes leave it open
    is_short = (F.octet_length(text) < 4 * SHORT) & (F.length(text) < SHORT)
    return df.withColumn(
        "description_ar", F.when(is_short, lengthened(mode)).otherwise(F.col("description_ar"))
    )


def postprocess(df: DataFrame, remap: DataFrame, mode: str = "spread") -> DataFrame:
    """Remap, then priority, then enrichment: narrow but for the broadcast of the remap."""
    return enrich_short(recompute_priority(remap_leaves(df, remap)), mode)
