"""Contextual matching, precedence waterfalls and roll-ups (MAT01-MAT19)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verigrid.functions.text import match_key, standardize, strip_footnote, strip_stars
from verigrid.operators.scale import attach_group_values, carry_forward, lookup, with_context


# --- places -----------------------------------------------------------------

def code_hierarchy(places: DataFrame, levels: Mapping[str, tuple[int, Sequence[str]]], width: int) -> DataFrame:
    """Ancestors by code prefix, published only when the ancestor row exists.

    ``places`` has code, name and place_type. ``levels`` maps a level name to its
    prefix length and to the place types that may hold it.
    """
    out = places
    for level, (keep, types) in levels.items():
        parents = places.filter(F.col("place_type").isin(*types)).select(
            F.col("code").alias(f"{level}_code"), F.col("name").alias(f"{level}_name")
        )
        wanted = F.rpad(F.substring("code", 1, keep), width, "0")
        out = out.join(parents, F.col(f"{level}_code") == wanted, "left")
    return out


def hierarchy_status(top: str, leaf: str) -> Column:
    """Status of a place after ``code_hierarchy`` with the levels region and locality."""
    return (
        F.when(F.col("place_type") == "UNASSIGNED", "UNASSIGNED_GEOGRAPHIC_LEVEL")
        .when((F.col("place_type") != top) & F.col("region_code").isNull(), "MISSING_VERIFIED_REGION")
        .when((F.col("place_type") == leaf) & F.col("locality_code").isNull(), "MISSING_VERIFIED_LOCALITY")
        .otherwise("VALID_HIERARCHY")
    )


def reporting_areas(kinds: Mapping[str, DataFrame]) -> DataFrame:
    """Union of member kinds (code, name, parent_code) plus the unknown member 0."""
    out = None
    for kind, members in kinds.items():
        part = members.select(
            "code", "name", F.lit(kind).alias("area_type"), "parent_code",
            F.lit(True).alias("is_geographic_area"),
        )
        out = part if out is None else out.unionByName(part)
    spark = out.sparkSession
    unknown = spark.range(1).select(
        F.lit(None).cast("string").alias("code"), F.lit("Unknown or unmapped").alias("name"),
        F.lit("UNKNOWN").alias("area_type"), F.lit(None).cast("string").alias("parent_code"),
        F.lit(False).alias("is_geographic_area"),
    )
    return out.unionByName(unknown)


# --- sheets with headings -----------------------------------------------------

def sheet_rows(raw: DataFrame) -> DataFrame:
    """Names of dump rows in the forms the waterfall compares (file, sheet, row_no, place_name)."""
    collapsed = F.regexp_replace(F.trim("place_name"), r"\s+", " ")
    name = strip_stars(standardize(F.col("place_name")))
    named = raw.withColumns(
        {
            "name_std": name,
            "heading_std": F.regexp_replace(name, r"\s+[0-9]+$", ""),
            "name_bare": strip_footnote(standardize(F.col("place_name"))),
            "sheet_std": standardize(F.col("sheet")),
            "is_uppercase": collapsed == F.upper(collapsed),
        }
    )
    keyed = named.withColumns(
        {
            "name_key": match_key(F.col("name_std")),
            "heading_key": match_key(F.col("heading_std")),
            "bare_key": F.when(F.col("name_bare") != F.col("name_std"), match_key(F.col("name_bare"))),
        }
    )
    return attach_group_values(keyed, ["file", "sheet"], {"first_row_no": F.min("row_no")})


def section_context(
    rows: DataFrame, places: DataFrame, aliases: DataFrame, preferred: Sequence[str], fallback: Sequence[str]
) -> DataFrame:
    """One context place per sheet: exact name first, then an approved alias; unique or nothing.

    ``places`` has code, name_std, place_type, region_std; ``aliases`` are acting rows
    with alias_std, region_std and target_code. A blank alias region never authorises.
    """
    sheets = rows.select("file", "sheet", "sheet_std").distinct()

    def counted(frame: DataFrame, prefix: str) -> DataFrame:
        first, second = F.col("place_type").isin(*preferred), F.col("place_type").isin(*fallback)
        counts = frame.groupBy("file", "sheet").agg(
            F.countDistinct(F.when(first, F.col("code"))).alias("n1"),
            F.max(F.when(first, F.col("code"))).alias("c1"),
            F.countDistinct(F.when(second, F.col("code"))).alias("n2"),
            F.max(F.when(second, F.col("code"))).alias("c2"),
        )
        return counts.select(
            "file", "sheet",
            F.when(F.col("n1") > 0, F.col("n1")).otherwise(F.col("n2")).alias(f"{prefix}_count"),
            F.when(F.col("n1") > 0, F.col("c1")).otherwise(F.col("c2")).alias(f"{prefix}_code"),
        )

    exact = counted(sheets.join(places, F.col("sheet_std") == F.col("name_std")), "exact")
    named = aliases.filter(F.coalesce(F.trim("region_std"), F.lit("")) != "").select(
        "alias_std", F.col("region_std").alias("alias_region"), "target_code"
    )
    by_alias = (
        sheets.join(named, F.col("sheet_std") == F.col("alias_std"))
        .join(places, (F.col("target_code") == F.col("code")) & (F.col("alias_region") == F.col("region_std")))
        .groupBy("file", "sheet")
        .agg(F.countDistinct("code").alias("alias_count"), F.max("code").alias("alias_code"))
    )
    joined = sheets.join(exact, ["file", "sheet"], "left").join(by_alias, ["file", "sheet"], "left")
    has_exact = F.coalesce(F.col("exact_count"), F.lit(0)) > 0
    count = F.when(has_exact, F.col("exact_count")).otherwise(F.coalesce("alias_count", F.lit(0)))
    code = F.when(has_exact, F.col("exact_code")).otherwise(F.col("alias_code"))
    return joined.select(
        "file", "sheet",
        count.alias("sheet_candidate_count"),
        F.when(count == 1, code).alias("sheet_code"),
        F.when(has_exact, "EXACT_NAME")
        .when(F.coalesce(F.col("alias_count"), F.lit(0)) > 0, "APPROVED_ALIAS")
        .otherwise("NONE")
        .alias("sheet_context_method"),
    )


def best_rank_per_row(candidates: DataFrame, row_key: str) -> DataFrame:
    """The best rank of each row with its distinct targets, as two nested aggregates."""
    per_rank = candidates.groupBy(row_key, "match_rank").agg(
        F.countDistinct("target").alias("candidate_count"),
        F.max("target").alias("target"),
        F.max("match_method").alias("match_method"),
    )
    best = per_rank.groupBy(row_key).agg(
        F.min_by(F.struct("match_rank", "match_method", "candidate_count", "target"), "match_rank").alias("b")
    )
    return best.select(row_key, "b.match_rank", "b.match_method", "b.candidate_count", "b.target")


def heading_context(rows: DataFrame, localities: DataFrame, aliases: DataFrame) -> DataFrame:
    """Locality headings: exact name 1, approved alias 2, normalised key 3, inside the sheet's place.

    ``rows`` carry ``sheet_code``; ``localities`` have code, name_std, name_key and
    ``sheet_code`` of the place that holds them. Only upper-case rows below the first
    row can be headings.
    """
    heads = rows.filter(F.col("is_uppercase") & (F.col("row_no") != F.col("first_row_no")))
    places = localities.select(
        F.col("sheet_code").alias("p_sheet"), F.col("code").alias("target"),
        F.col("name_std").alias("p_name"), F.col("name_key").alias("p_key"),
    )

    def found(condition: Column, rank: int, method: str, left: DataFrame = heads) -> DataFrame:
        joined = left.join(places, (F.col("sheet_code") == F.col("p_sheet")) & condition)
        return joined.select(
            "row_id", F.lit(rank).alias("match_rank"), F.lit(method).alias("match_method"), "target"
        )

    aliased = heads.join(aliases.select("alias_std", "target_code"), F.col("heading_std") == F.col("alias_std"))
    candidates = (
        found(F.col("heading_std") == F.col("p_name"), 1, "EXACT_CONTEXT")
        .unionByName(found(F.col("target_code") == F.col("target"), 2, "APPROVED_ALIAS", aliased))
        .unionByName(found(F.col("heading_key") == F.col("p_key"), 3, "NORMALIZED_NAME_CONTEXT"))
    )
    return best_rank_per_row(candidates, "row_id")


def row_roles(rows: DataFrame, headings: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Role of each row, decided before leaf matching."""
    found = headings.select(
        "row_id",
        F.col("candidate_count").alias("heading_candidate_count"),
        F.col("target").alias("heading_code"),
        F.col("match_rank").alias("heading_rank"),
        F.col("match_method").alias("heading_method"),
    )
    allowed = exceptions.select("file", "sheet", "name_std", F.lit(True).alias("__exception")).distinct()
    joined = rows.join(found, "row_id", "left").join(allowed, ["file", "sheet", "name_std"], "left")
    resolved = F.coalesce(F.col("heading_candidate_count"), F.lit(0)) == 1
    role = (
        F.when(resolved, "RESOLVED_HEADING")
        .when(F.col("is_uppercase") & F.col("__exception").isNotNull(), "APPROVED_UPPERCASE_LEAF")
        .when(F.col("is_uppercase") & (F.col("row_no") != F.col("first_row_no")), "UNRESOLVED_HEADING_LIKE")
        .otherwise("NORMAL_LEAF_CANDIDATE")
    )
    return joined.withColumn("row_role", role).drop("__exception")


def carry_context(rows: DataFrame, own_locality: Column | None = None, block_rows: int = 1_000_000) -> DataFrame:
    """Carry the heading's locality down the sheet and fail closed after an unresolved heading.

    An unresolved heading carries a reset (a struct with a NULL code). Every later row
    up to the next resolved heading is marked ``follows_unresolved``. Before the first
    heading ``own_locality`` applies, for a sheet that is its own locality.
    """
    role = F.col("row_role")
    mark = F.when(
        role == "RESOLVED_HEADING",
        F.struct(F.col("heading_code").alias("code"), F.lit(False).alias("broken")),
    ).when(
        role == "UNRESOLVED_HEADING_LIKE",
        F.struct(F.lit(None).cast("string").alias("code"), F.lit(True).alias("broken")),
    )
    marked = rows.withColumn("__mark", mark)
    carried = carry_forward(
        marked, ["file", "sheet"], "row_no", block_rows, {"__before": F.col("__mark")}, strict=True
    )
    context = F.coalesce("__mark", "__before")
    own = F.lit(None).cast("string") if own_locality is None else own_locality
    return carried.withColumns(
        {
            "locality_code": F.when(context.isNotNull(), context["code"]).otherwise(own),
            "follows_unresolved": (role != "RESOLVED_HEADING")
            & F.coalesce(F.col("__before.broken"), F.lit(False)),
        }
    ).drop("__mark", "__before")


def leaf_candidates(rows: DataFrame, places: DataFrame, aliases: DataFrame) -> DataFrame:
    """Leaf candidates under the verified locality, with their waterfall rank.

    1 exact name, 2 approved alias, 3 normalised key, 4 footnote number removed. Each
    rank is an equi join on locality and name.
    """
    leaves = rows.filter(
        F.col("row_role").isin("APPROVED_UPPERCASE_LEAF", "NORMAL_LEAF_CANDIDATE")
        & ~(F.col("is_uppercase") & (F.col("row_no") == F.col("first_row_no")))
        & F.col("locality_code").isNotNull()
    )
    normal = leaves.filter(F.col("row_role") == "NORMAL_LEAF_CANDIDATE")
    targets = places.select(
        F.col("locality_code").alias("p_locality"), F.col("code").alias("target"),
        F.col("name_std").alias("p_name"), F.col("name_key").alias("p_key"),
    )

    def found(left: DataFrame, condition: Column, rank: int, method: str) -> DataFrame:
        joined = left.join(targets, (F.col("locality_code") == F.col("p_locality")) & condition)
        return joined.select(
            "row_id", F.lit(rank).alias("match_rank"), F.lit(method).alias("match_method"), "target"
        )

    aliased = leaves.join(
        aliases.select("alias_std", "alias_locality", F.col("target_code").alias("target")),
        (F.col("name_std") == F.col("alias_std")) & (F.col("locality_code") == F.col("alias_locality")),
    ).select("row_id", F.lit(2).alias("match_rank"), F.lit("APPROVED_ALIAS").alias("match_method"), "target")
    return (
        found(leaves, F.col("name_std") == F.col("p_name"), 1, "EXACT_CONTEXT")
        .unionByName(aliased)
        .unionByName(found(normal, F.col("name_key") == F.col("p_key"), 3, "NORMALIZED_NAME_CONTEXT"))
        .unionByName(found(normal, F.col("bare_key") == F.col("p_key"), 4, "FOOTNOTE_REMOVED_CONTEXT"))
    )


def match_candidates(rows: DataFrame, places: DataFrame, aliases: DataFrame) -> DataFrame:
    """Every candidate with its rank: sheet title, resolved headings and leaves."""
    titles = rows.filter(F.col("row_no") == F.col("first_row_no")).join(
        places.select(F.col("code").alias("target"), F.col("name_std").alias("p_name")),
        (F.col("sheet_code") == F.col("target")) & (F.col("name_std") == F.col("p_name")),
    )
    titles = titles.select(
        "row_id", F.lit(1).alias("match_rank"), F.lit("EXACT_CONTEXT").alias("match_method"), "target"
    )
    headings = rows.filter(F.col("row_role") == "RESOLVED_HEADING").select(
        "row_id", F.col("heading_rank").alias("match_rank"),
        F.col("heading_method").alias("match_method"), F.col("heading_code").alias("target"),
    )
    leaves = leaf_candidates(rows, places.filter("locality_code is not null"), aliases)
    return titles.unionByName(headings).unionByName(leaves)


def match_waterfall(candidates: DataFrame, row_key: str, last_primary: int = 2) -> DataFrame:
    """Choose the best rank per row; primary ranks claim targets, fallbacks may not take them.

    A row with a primary candidate uses its best primary rank. A primary row claims its
    target when that candidate is unique. Other rows use their best fallback rank over
    unclaimed targets, and a fallback target reached by several rows counts them all in
    ``target_claim_count``, so none of them is accepted. Everything runs on the
    candidates as aggregates and anti joins; no window is needed.
    """
    is_primary = F.col("match_rank") <= last_primary
    primary = best_rank_per_row(candidates.filter(is_primary), row_key)
    claimed = primary.filter("candidate_count = 1").select("target").distinct()
    open_fallback = (
        candidates.filter(~is_primary)
        .join(primary.select(row_key), row_key, "left_anti")
        .join(claimed, "target", "left_anti")
        .select(*candidates.columns)
    )
    fallback = best_rank_per_row(open_fallback, row_key)
    claims = fallback.filter("candidate_count = 1").groupBy("target").agg(
        F.count(F.lit(1)).alias("target_claim_count")
    )
    fallback = fallback.join(claims, "target", "left").withColumn(
        "target_claim_count", F.coalesce("target_claim_count", F.lit(0))
    )
    return primary.withColumn("target_claim_count", F.lit(1).cast("bigint")).unionByName(fallback)


def publish_matches(rows: DataFrame, selection: DataFrame, places: DataFrame, leaf_type: str) -> DataFrame:
    """One mutually exclusive status, disposition and reason per source row.

    ``rows`` carry ``population_count``; ``places`` carry code, place_type and
    ``crosscheck_count``.
    """
    chosen = selection.select(
        "row_id", F.col("match_method").alias("sel_method"),
        F.col("candidate_count").alias("sel_count"), F.col("target").alias("sel_target"),
        F.col("target_claim_count").alias("sel_claims"),
    )
    joined = rows.join(chosen, "row_id", "left")
    blank = F.coalesce(F.trim("place_name"), F.lit("")) == ""
    broken = (F.col("row_role") == "UNRESOLVED_HEADING_LIKE") | F.col("follows_unresolved")
    unique = F.coalesce((F.col("sel_count") == 1) & (F.col("sel_claims") == 1), F.lit(False))
    method = F.col("sel_method")
    status = (
        F.when(blank, "INVALID_SOURCE")
        .when(broken, "UNMATCHED")
        .when(unique & (method == "EXACT_CONTEXT"), "MATCHED_EXACT_CONTEXT")
        .when(unique & (method == "APPROVED_ALIAS"), "MATCHED_ALIAS")
        .when(unique, "MATCHED_NORMALIZED_CONTEXT")
        .when((F.col("sel_count") > 1) | (F.col("sel_claims") > 1), "AMBIGUOUS")
        .otherwise("UNMATCHED")
    )
    staged = joined.withColumn("match_status", status).withColumn(
        "matched_code", F.when(F.col("match_status").startswith("MATCHED"), F.col("sel_target"))
    )
    targets = places.select(
        F.col("code").alias("matched_code"), F.col("place_type").alias("matched_type"), "crosscheck_count"
    )
    enriched = staged.join(targets, "matched_code", "left")
    state, count = F.col("match_status"), F.col("population_count")
    difference = count - F.col("crosscheck_count")
    return enriched.withColumns(
        {
            "match_method": F.when(state.startswith("MATCHED"), method).otherwise("NO_ACCEPTED_METHOD"),
            "match_quality": F.when(state == "MATCHED_EXACT_CONTEXT", "HIGH")
            .when(state == "MATCHED_ALIAS", "REVIEWED")
            .when(state == "MATCHED_NORMALIZED_CONTEXT", "RULE_NORMALIZED")
            .otherwise("UNRESOLVED"),
            "reason": F.when(F.col("row_role") == "UNRESOLVED_HEADING_LIKE", "UNRESOLVED_HEADING")
            .when((state == "UNMATCHED") & F.col("follows_unresolved"), "FOLLOWS_UNRESOLVED_HEADING")
            .when((state == "AMBIGUOUS") & (F.col("sel_claims") > 1), "TARGET_REACHED_BY_SEVERAL_ROWS")
            .when(state == "AMBIGUOUS", "SEVERAL_CONTEXTUAL_CANDIDATES")
            .when((state == "UNMATCHED") & (F.col("sheet_candidate_count") != 1), "NO_UNIQUE_SHEET_CONTEXT")
            .when((state == "UNMATCHED") & F.col("locality_code").isNull(), "NO_VERIFIED_LOCALITY")
            .when(state == "INVALID_SOURCE", "MISSING_SOURCE_IDENTITY"),
            "row_disposition": F.when(count.isNull() | (count <= 0), "INVALID_POPULATION")
            .when(state == "INVALID_SOURCE", "SOURCE_EXCEPTION")
            .when(state.isin("AMBIGUOUS", "UNMATCHED"), state)
            .when(F.col("matched_type") == leaf_type, "ACCEPTED_PRIMARY")
            .otherwise("MATCHED_NON_PRIMARY_LEVEL"),
            "population_difference": difference,
            "population_difference_pct": F.when(
                count > 0, F.round(100.0 * difference.cast("double") / count, 4)
            ),
        }
    ).drop("sel_method", "sel_target")


# --- matches between sources and precedence ------------------------------------

def exact_match(
    source: DataFrame, target: DataFrame, source_key: Column, target_key: Column, target_id: str
) -> DataFrame:
    """Status per source key: MATCHED, UNMATCHED or AMBIGUOUS_TARGET; no arbitrary target.

    Both sides are reduced to one row per normalised key before they meet, so repeated
    keys never multiply.
    """
    keyed = source.select(source_key.alias("match_key")).filter("match_key is not null")
    sources = keyed.groupBy("match_key").agg(F.count(F.lit(1)).alias("source_rows"))
    targets = (
        target.select(target_key.alias("match_key"), F.col(target_id).alias("__id"))
        .filter("match_key is not null")
        .groupBy("match_key")
        .agg(F.count(F.lit(1)).alias("target_candidate_count"), F.max("__id").alias("__id"))
    )
    joined = sources.join(targets, "match_key", "left")
    count = F.coalesce("target_candidate_count", F.lit(0))
    return joined.select(
        "match_key", "source_rows", count.alias("target_candidate_count"),
        F.when(count == 1, "MATCHED").when(count == 0, "UNMATCHED").otherwise("AMBIGUOUS_TARGET").alias(
            "match_status"
        ),
        F.when(count == 1, F.col("__id")).alias("matched_id"),
    )


def candidate_evidence(candidates: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Per key and method: distinct candidate count and the target when it is unique.

    All methods travel through one union and one aggregate.
    """
    stacked = None
    for method, frame in candidates.items():
        part = frame.select(key, F.lit(method).alias("method"), F.col("target"))
        stacked = part if stacked is None else stacked.unionByName(part)
    grouped = stacked.distinct().groupBy(key)
    evidence = grouped.agg(
        *[F.count_if(F.col("method") == m).alias(f"{m}_count") for m in candidates],
        *[F.max(F.when(F.col("method") == m, F.col("target"))).alias(f"{m}_target") for m in candidates],
    )
    return evidence.select(
        key,
        *[f"{m}_count" for m in candidates],
        *[F.when(F.col(f"{m}_count") == 1, F.col(f"{m}_target")).alias(f"{m}_target") for m in candidates],
    )


def with_evidence(rows: DataFrame, candidates: Mapping[str, DataFrame], key: str) -> DataFrame:
    joined = rows.join(candidate_evidence(candidates, key), key, "left")
    return joined.withColumns(
        {f"{m}_count": F.coalesce(f"{m}_count", F.lit(0)) for m in candidates}
    )


def precedence(
    rows: DataFrame,
    candidates: Mapping[str, DataFrame],
    key: str,
    excluded: Column,
    labels: Mapping[str, tuple[str, str]],
    spatial: str,
    coordinate_ok: Column,
    missing_name: Column,
) -> DataFrame:
    """Strict waterfall: the first method with any candidate decides.

    Several candidates at that method are AMBIGUOUS; they never fall through. A
    disagreeing unique spatial candidate turns a match into MATCHED_WITH_CONFLICT.
    ``labels`` maps each method to its published method name and quality.
    """
    methods = list(candidates)
    joined = with_evidence(rows, candidates, key)
    excluded = F.coalesce(excluded, F.lit(False))
    method = F.when(excluded, "NON_GEOGRAPHIC_RULE")
    target: Column | None = None
    count = F.when(excluded, 0)
    for m in methods:
        hit = F.col(f"{m}_count") > 0
        method = method.when(hit, labels[m][0])
        count = count.when(hit, F.col(f"{m}_count"))
        target = (
            F.when(excluded, None).when(hit, F.col(f"{m}_target"))
            if target is None
            else target.when(hit, F.col(f"{m}_target"))
        )
    staged = joined.withColumns(
        {
            "mapping_method": method.otherwise("NONE"),
            "accepted_target": target,
            "candidate_count": count.otherwise(0).cast("bigint"),
        }
    )
    accepted, chosen = F.col("accepted_target"), F.col("mapping_method")
    unique_spatial = F.col(f"{spatial}_count") == 1
    quality = F.when(chosen == "NON_GEOGRAPHIC_RULE", "REVIEWED")
    for m in methods:
        if m == spatial:
            quality = quality.when((chosen == labels[m][0]) & (F.col("candidate_count") == 1), labels[m][1])
        else:
            quality = quality.when(chosen == labels[m][0], labels[m][1])
    return staged.withColumns(
        {
            "match_status": F.when(chosen == "NON_GEOGRAPHIC_RULE", "NON_GEOGRAPHIC")
            .when(F.col("candidate_count") > 1, "AMBIGUOUS")
            .when(accepted.isNull(), "UNMATCHED")
            .when(
                (chosen != labels[spatial][0]) & unique_spatial & (accepted != F.col(f"{spatial}_target")),
                "MATCHED_WITH_CONFLICT",
            )
            .otherwise("MATCHED"),
            "match_quality": quality.when(F.col("candidate_count") > 1, "REVIEW_REQUIRED").otherwise(
                "UNRESOLVED"
            ),
            "coordinate_crosscheck": F.when(
                chosen == "NON_GEOGRAPHIC_RULE", "NOT_APPLICABLE_NON_GEOGRAPHIC"
            )
            .when(~coordinate_ok, "NOT_AVAILABLE")
            .when(F.col(f"{spatial}_count") == 0, "NO_BOUNDARY_MATCH")
            .when(F.col(f"{spatial}_count") > 1, "AMBIGUOUS_BOUNDARY")
            .when(accepted == F.col(f"{spatial}_target"), "REGION_MATCH")
            .when(accepted.isNotNull(), "REGION_MISMATCH")
            .otherwise("SPATIAL_ONLY"),
            "mapping_reason": F.when(chosen != "NONE", chosen)
            .when(missing_name, "MISSING_REPORTED_NAME")
            .when(~coordinate_ok, "NO_ACCEPTED_NAME_AND_NO_USABLE_COORDINATE")
            .otherwise("NO_ACCEPTED_CANDIDATE"),
        }
    )


def area_precedence(
    rows: DataFrame,
    candidates: Mapping[str, DataFrame],
    key: str,
    excluded: Column,
    coordinate_ok: Column,
) -> DataFrame:
    """Area waterfall over the methods manual, alias, spatial; ``exact`` is diagnostic only.

    Only a unique candidate is accepted and an ambiguous alias *does* fall through to
    the spatial stage. Unresolved rows go to key 0. The conflict flag also sees several
    spatial candidates and a disagreeing exact name.
    """
    joined = with_evidence(rows, candidates, key)
    excluded = F.coalesce(excluded, F.lit(False))
    method = (
        F.when(excluded, "NON_GEOGRAPHIC")
        .when(F.col("manual_count") == 1, "MANUAL_EXCEPTION")
        .when(F.col("alias_count") == 1, "APPROVED_ALIAS")
        .when(F.col("spatial_count") == 1, "COORDINATE_BOUNDARY")
        .otherwise("NONE")
    )
    staged = joined.withColumn("mapping_method", method)
    chosen = F.col("mapping_method")
    staged = staged.withColumn(
        "area_key",
        F.when(chosen == "MANUAL_EXCEPTION", F.col("manual_target"))
        .when(chosen == "APPROVED_ALIAS", F.col("alias_target"))
        .when(chosen == "COORDINATE_BOUNDARY", F.col("spatial_target"))
        .otherwise(F.lit(0)),
    )
    area = F.col("area_key")
    conflict = (area != 0) & (
        ((F.col("exact_count") == 1) & (F.col("exact_target") != area))
        | ((F.col("spatial_count") == 1) & (F.col("spatial_target") != area))
        | (F.col("spatial_count") > 1)
    )
    staged = staged.withColumn("conflict_flag", F.coalesce(conflict, F.lit(False)))
    return staged.withColumns(
        {
            "match_status": F.when(chosen == "NON_GEOGRAPHIC", "NON_GEOGRAPHIC")
            .when((area != 0) & F.col("conflict_flag"), "MATCHED_WITH_CONFLICT")
            .when(area != 0, "MATCHED")
            .when((F.col("spatial_count") > 1) | (F.col("alias_count") > 1), "AMBIGUOUS")
            .otherwise("UNMAPPED"),
            "match_quality": F.when(chosen == "MANUAL_EXCEPTION", "REVIEWED")
            .when(chosen == "APPROVED_ALIAS", "REVIEWED_EXACT")
            .when(chosen == "COORDINATE_BOUNDARY", "SPATIAL_UNIQUE")
            .when(chosen == "NON_GEOGRAPHIC", "NOT_APPLICABLE")
            .otherwise("UNRESOLVED"),
            "mapping_reason": F.when(chosen != "NONE", chosen)
            .when(F.col("spatial_count") > 1, "SEVERAL_BOUNDARIES_COVER_THE_POINT")
            .when(~coordinate_ok, "NO_USABLE_COORDINATE_AND_NO_STRONGER_EVIDENCE")
            .otherwise("NO_APPROVED_EVIDENCE"),
        }
    )


def evidence_group(name: str = "exact", place: str = "spatial") -> Column:
    """Agreement of two kinds of evidence on rows from ``with_evidence``."""
    names, points = F.col(f"{name}_count"), F.col(f"{place}_count")
    same = F.col(f"{name}_target") == F.col(f"{place}_target")
    return (
        F.when((names == 1) & (points == 1) & same, "NAME_COORDINATE_AGREE")
        .when((names == 1) & (points == 1), "NAME_COORDINATE_CONFLICT")
        .when((names == 1) & (points == 0), "EXACT_NAME_ONLY")
        .when((names == 0) & (points == 1), "UNIQUE_COORDINATE_ONLY")
        .when((names > 1) | (points > 1), "AMBIGUOUS")
        .otherwise("UNMAPPED")
    )


def evidence_profile(rows: DataFrame, money: str) -> DataFrame:
    """Row and money coverage per evidence group."""
    grouped = rows.withColumn("evidence_group", evidence_group()).groupBy("evidence_group").agg(
        F.count(F.lit(1)).alias("projects"),
        F.count(money).alias("projects_with_money"),
        F.sum(money).alias("money"),
    )
    total = grouped.agg(F.sum("projects").alias("__n"), F.sum("money").alias("__m"))
    pct = lambda part, whole: F.round(100.0 * F.col(part).cast("double") / F.col(whole).cast("double"), 2)
    return grouped.transform(with_context, total).select(
        "evidence_group", "projects", "projects_with_money", "money",
        pct("projects", "__n").alias("project_pct"), pct("money", "__m").alias("money_pct"),
    )


def contract_gaps(observed: DataFrame, members: DataFrame, published: DataFrame) -> DataFrame:
    """Counts of codes outside the member list, members never observed, members not published."""
    def count(frame: DataFrame, label: str) -> DataFrame:
        return frame.agg(F.lit(label).alias("gap"), F.count(F.lit(1)).alias("codes"))

    seen, member, out = (f.select("code").distinct() for f in (observed, members, published))
    return (
        count(seen.join(member, "code", "left_anti"), "OBSERVED_CODE_NOT_A_MEMBER")
        .unionByName(count(member.join(seen, "code", "left_anti"), "MEMBER_WITHOUT_OBSERVATION"))
        .unionByName(count(member.join(out, "code", "left_anti"), "MEMBER_WITHOUT_PUBLICATION"))
    )


def resolve_point_class(points: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Class of a point from the polygons that hold it; severity never breaks a tie.

    ``candidates`` has key and level, one row per polygon, or rows that stand for as many as their
    column ``polygons`` says. Several polygons of one level are still MATCHED. Candidates are
    counted by level first, so a point brings a few rows to the second step, however many
    polygons hold it.
    """
    number = F.sum("polygons") if "polygons" in candidates.columns else F.count(F.lit(1))
    per_level = candidates.groupBy(key, "level").agg(number.alias("__polygons"))
    found = per_level.groupBy(key).agg(
        F.sum("__polygons").alias("polygon_count"),
        F.count("level").alias("level_count"),
        F.concat_ws(",", F.sort_array(F.collect_list("level"))).alias("candidate_levels"),
        F.max("level").alias("__level"),
    )
    joined = points.join(found, key, "left")
    count = F.coalesce("level_count", F.lit(0))
    status = F.when(count == 1, "MATCHED").when(count > 1, "AMBIGUOUS").otherwise("UNMATCHED")
    return joined.withColumns(
        {
            "polygon_count": F.coalesce("polygon_count", F.lit(0)),
            "level_count": count,
            "candidate_levels": F.coalesce("candidate_levels", F.lit("")),
            "match_status": status,
            "level": F.when(count == 1, F.col("__level")),
            "exception_reason": F.when(count == 1, None)
            .when(count > 1, "MULTIPLE_APPROVED_LEVELS")
            .when(F.col("coordinate_status") == "MISSING_PAIR", "MISSING_COORDINATE_PAIR")
            .when(F.col("coordinate_status") == "PARTIAL_PAIR", "PARTIAL_COORDINATE_PAIR")
            .when(F.col("coordinate_status") == "OUT_OF_RANGE", "COORDINATE_OUT_OF_RANGE")
            .otherwise("NO_APPROVED_INTERSECTION"),
        }
    ).drop("__level")


# --- roll-ups -------------------------------------------------------------------

def rollup_leaves(matches: DataFrame, members: DataFrame, member_of: str) -> DataFrame:
    """Population per official member from accepted leaf rows only.

    Subtotals never enter, every member is kept, a member without rows stays NULL.
    """
    accepted = matches.filter(F.col("row_disposition") == "ACCEPTED_PRIMARY")
    totals = accepted.groupBy(F.col(member_of).alias("code")).agg(
        F.sum("population_count").alias("population_count"), F.count(F.lit(1)).alias("source_row_count")
    )
    joined = members.join(totals, "code", "left")
    return joined.withColumns(
        {
            "source_row_count": F.coalesce("source_row_count", F.lit(0)),
            "population_match_status": F.when(
                F.col("population_count").isNull(), "MISSING_PRIMARY_POPULATION"
            ).otherwise("MATCHED_PRIMARY_POPULATION"),
        }
    )


def excluded_totals(matches: DataFrame) -> DataFrame:
    """Amounts that stay outside every member, shown on the unknown member."""
    leaf = F.col("row_role").isin("APPROVED_UPPERCASE_LEAF", "NORMAL_LEAF_CANDIDATE")
    return matches.filter(F.col("row_disposition") != "ACCEPTED_PRIMARY").agg(
        F.lit(0).alias("reporting_area_key"),
        F.sum(F.when(leaf & (F.col("population_count") > 0), F.col("population_count"))).alias(
            "excluded_population_count"
        ),
        F.count(F.lit(1)).alias("excluded_source_row_count"),
    )
