"""Watch-list and exposed-person screening."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import c, choose, days, flag, ladder, mean, on_date, rnd
from tidemark.functions.similar import containment_pairs, edit_pairs
from tidemark.functions.spread import EASY, salted_join

DISTANCE_SCORE = {1: 95.0, 2: 90.0, 3: 85.0, 4: 80.0, 5: 75.0}


def watch_list_enriched(watch_list: DataFrame, *, as_of) -> DataFrame:
    today = on_date(as_of)
    name, authority = F.col("list_name"), F.col("authority")
    return watch_list.select(
        "*",
        ladder(
            [
                ((authority == "DOT - Department of Treasury") & name.contains("SDN"), 10),
                (authority.contains("UK") | authority.contains("Canada"), 7),
                (F.col("entity_type") == "Individual", 8),
                (F.col("entity_type") == "Vessel", 5),
            ],
            6,
        ).alias("risk_score"),
        (F.col("expiry_date").isNull() | flag(F.col("expiry_date") > today)).alias("is_active"),
        ladder(
            [
                (name.contains("SDN"), "OFAC Specially Designated Nationals (SDN)"),
                (name.contains("UK Sanctions"), "UK Russia Sanctions"),
                (name.contains("Canada"), "Canada Port State Control"),
            ],
            name,
        ).alias("sanctions_program"),
        ladder(
            [
                (authority.contains("DOT") | authority.contains("Treasury"), "US_OFAC"),
                (authority.contains("UK") | authority.contains("FCDO"), "UK_OFSI"),
                (authority.contains("Canada"), "CANADA_PSC"),
                (authority.contains("EU"), "EU_SANCTIONS"),
                (authority.contains("SECO"), "SWISS_SECO"),
            ],
            "OTHER",
        ).alias("authority_category"),
        days("effective_date", today).alias("days_since_listing"),
        days(today, "expiry_date").alias("days_until_expiry"),
    )


def _people(customers: DataFrame) -> DataFrame:
    full = F.concat_ws(" ", "first_name", "family_name")
    return customers.withColumn("customer_name", full).withColumn("_name", F.upper(full))


def exact_match(people: DataFrame, listed: DataFrame) -> DataFrame:
    """Customers whose full name equals an active entry, ignoring case."""
    return salted_join(people, listed.withColumn("_name", F.upper("entity_name")), "_name").withColumns(
        {"match_type": F.lit("EXACT_MATCH"), "match_score": F.lit(100.0), "edit_distance": F.lit(0)}
    )


def name_pairs(customers: DataFrame, watch_list: DataFrame, *, as_of, k: int = 5) -> DataFrame:
    """Distinct upper-case names (a) within ``k`` edits of an active entry (b), with their distance."""
    listed = watch_list_enriched(watch_list, as_of=as_of).where("is_active")
    return edit_pairs(_people(customers), "_name", listed, F.upper("entity_name"), k)


def alias_pairs(customers: DataFrame, watch_list: DataFrame, *, as_of) -> DataFrame:
    """Distinct upper-case names (a) that the alias text (b) of an active entry contains."""
    listed = watch_list_enriched(watch_list, as_of=as_of).where("is_active")
    return containment_pairs(_people(customers), "_name", listed, F.upper("entity_aliases"))


def _matched(people: DataFrame, pairs: DataFrame, listed: DataFrame, listed_name) -> DataFrame:
    """Customers and entries of the paired names, without entries of an identifier that also has the customer's name.

    There may be far more pairs than customers or entries, so they are shuffled as narrow rows, and the wide columns of
    the entries come last.  A name that very many hold, on either side, is split; pairs should be stored, as they are
    counted first.
    """
    pairs = pairs.withColumnRenamed("a", "_name")
    held = people.groupBy("_name").agg(F.count(F.lit(1)).alias("_held")).where(F.col("_held") > EASY)
    # at most one name for each EASY customers
    weights = pairs.join(F.broadcast(held), "_name", "left").select("b", F.coalesce("_held", F.lit(1)).alias("_held"))
    met = salted_join(pairs, people, "_name", small=True)
    named = listed.where(F.col("entity_id").isNotNull()).groupBy("entity_id").agg(F.collect_set(F.upper("entity_name")).alias("_names"))
    entries = listed.join(named, "entity_id", "left").withColumn("b", listed_name)
    same = F.col("customer_id").isNotNull() & F.array_contains("_names", F.col("_name"))
    return salted_join(met, entries, "b", counted=(weights, "_held"), small=True).where(~flag(same)).drop("b", "_names")


def fuzzy_match(people: DataFrame, listed: DataFrame, pairs: DataFrame) -> DataFrame:
    """Entries whose name is paired with the customer's, minus entries already matched exactly.

    ``people`` has a row for each customer.
    """
    return (
        _matched(people, pairs, listed, F.upper("entity_name"))
        .withColumns(
            {
                "match_type": F.lit("FUZZY_MATCH"),
                "match_score": ladder([(F.col("distance") <= d, s) for d, s in DISTANCE_SCORE.items()], 70.0),
            }
        )
        .withColumnRenamed("distance", "edit_distance")
    )


def alias_match(people: DataFrame, listed: DataFrame, pairs: DataFrame) -> DataFrame:
    """Entries whose alias text contains the customer's full name, minus entries already matched exactly."""
    return _matched(people, pairs, listed, F.upper("entity_aliases")).withColumns(
        {"match_type": F.lit("ALIAS_MATCH"), "match_score": F.lit(95.0), "edit_distance": F.lit(0)}
    )


MATCH_COLUMNS = [
    "customer_id", "customer_name", "customer_dob", "customer_country", "customer_nationality", "customer_type",
    "risk_classification", "entity_id", "entity_name", "entity_aliases", "sanctions_dob", "sanctions_nationality",
    "authority", "list_name", "sanctions_program", "sanctions_risk_score", "sanctions_is_active", "effective_date",
    "expiry_date", "citation_link", "match_type", "match_score", "edit_distance",
]


def screening_inputs(customers: DataFrame, addresses: DataFrame, watch_list: DataFrame, *, as_of):
    where = addresses.select("customer_id", F.col("country").alias("_country"))
    people = _people(customers).join(where, "customer_id", "left")
    people = people.select(
        "customer_id",
        "customer_name",
        "_name",
        F.col("date_of_birth").alias("customer_dob"),
        F.coalesce("_country", F.lit("UNKNOWN")).alias("customer_country"),
        F.lit(None).cast("string").alias("customer_nationality"),
        F.lit(None).cast("string").alias("customer_type"),
        "risk_classification",
    )
    listed = watch_list_enriched(watch_list, as_of=as_of).where("is_active")
    listed = listed.select(
        "entity_id",
        "entity_name",
        "entity_aliases",
        F.col("dob").alias("sanctions_dob"),
        F.col("nationality_country").alias("sanctions_nationality"),
        "authority",
        "list_name",
        "sanctions_program",
        F.col("risk_score").alias("sanctions_risk_score"),
        F.col("is_active").alias("sanctions_is_active"),
        "effective_date",
        "expiry_date",
        "citation_link",
    )
    return people, listed


def name_matches(
    customers, addresses, watch_list, pairs: DataFrame, aliases: DataFrame, *, as_of, kind: str = "all"
) -> DataFrame:
    """Matches of one kind or of all; the pairs are what ``name_pairs`` and ``alias_pairs`` give for the same inputs."""
    people, listed = screening_inputs(customers, addresses, watch_list, as_of=as_of)
    found = {
        "exact": lambda: exact_match(people, listed),
        "fuzzy": lambda: fuzzy_match(people, listed, pairs),
        "alias": lambda: alias_match(people, listed, aliases),
    }
    kinds = [f().select(*MATCH_COLUMNS) for name, f in found.items() if kind in (name, "all")]
    return reduce(DataFrame.unionByName, kinds)


def customer_screening(customers, addresses, watch_list, pairs: DataFrame, aliases: DataFrame, *, as_of) -> DataFrame:
    """All matches with confidence, disposition, combined score and priority."""
    found = name_matches(customers, addresses, watch_list, pairs, aliases, as_of=as_of)
    kind, score = F.col("match_type"), F.col("match_score")
    dob, nat = F.col("dob_match"), F.col("nationality_match")
    found = found.withColumns(
        {
            "dob_match": flag(
                ~F.col("sanctions_dob").contains("[")
                & (F.date_format("customer_dob", "yyyy-MM-dd") == F.col("sanctions_dob"))
            ),
            "nationality_match": flag(F.col("customer_nationality") == F.col("sanctions_nationality")),
            "country_match": flag(F.col("customer_country") == F.col("sanctions_nationality")),
        }
    )
    exact, alias = kind == "EXACT_MATCH", kind == "ALIAS_MATCH"
    return found.withColumns(
        {
            "match_confidence": ladder(
                [
                    (exact, "EXACT"),
                    (alias | (score >= 90), "HIGH_CONFIDENCE"),
                    (score >= 80, "MEDIUM_CONFIDENCE"),
                    (score >= 70, "LOW_CONFIDENCE"),
                ],
                "VERY_LOW_CONFIDENCE",
            ),
            "disposition_recommendation": ladder(
                [
                    (exact & dob, "HARD_BLOCK"),
                    (exact | alias | ((score >= 90) & (dob | nat)), "IMMEDIATE_INVESTIGATION"),
                    (score >= 85, "ENHANCED_DUE_DILIGENCE"),
                    (score >= 75, "MANUAL_REVIEW"),
                ],
                "LIKELY_FALSE_POSITIVE",
            ),
            "combined_risk_score": choose(
                "risk_classification", {"CRITICAL": 10, "HIGH": 8, "MEDIUM": 5, "LOW": 3}, 5
            )
            + F.col("sanctions_risk_score"),
            "alert_priority": ladder(
                [(exact & dob, "CRITICAL"), (exact | alias | (score >= 85), "HIGH"), (score >= 75, "MEDIUM")], "LOW"
            ),
        }
    )


def screening_summary(screening: DataFrame) -> DataFrame:
    """One row.  Collapses to one row per customer first, so each count is a plain sum."""
    authority = F.col("authority")
    hits = {
        "exact_match_customers": F.col("match_type") == "EXACT_MATCH",
        "fuzzy_match_customers": F.col("match_type") == "FUZZY_MATCH",
        "alias_match_customers": F.col("match_type") == "ALIAS_MATCH",
        "exact_confidence_customers": F.col("match_confidence") == "EXACT",
        "high_confidence_customers": F.col("match_confidence") == "HIGH_CONFIDENCE",
        "medium_confidence_customers": F.col("match_confidence") == "MEDIUM_CONFIDENCE",
        "low_confidence_customers": F.col("match_confidence") == "LOW_CONFIDENCE",
        "hard_block_required": F.col("disposition_recommendation") == "HARD_BLOCK",
        "immediate_investigation_required": F.col("disposition_recommendation") == "IMMEDIATE_INVESTIGATION",
        "edd_required": F.col("disposition_recommendation") == "ENHANCED_DUE_DILIGENCE",
        "manual_review_required": F.col("disposition_recommendation") == "MANUAL_REVIEW",
        "likely_false_positives": F.col("disposition_recommendation") == "LIKELY_FALSE_POSITIVE",
        "critical_alerts": F.col("alert_priority") == "CRITICAL",
        "high_alerts": F.col("alert_priority") == "HIGH",
        "medium_alerts": F.col("alert_priority") == "MEDIUM",
        "low_alerts": F.col("alert_priority") == "LOW",
        "ofac_matches": authority.contains("DOT") | authority.contains("Treasury"),
        "uk_matches": authority.contains("UK"),
        "canada_matches": authority.contains("Canada"),
    }
    per_customer = screening.groupBy("customer_id").agg(
        *[F.max(flag(cond)).alias(name) for name, cond in hits.items()]
    )
    counts = per_customer.agg(
        F.count(F.lit(1)).alias("total_customers_with_matches"), *[F.count_if(name).alias(name) for name in hits]
    )
    totals = screening.agg(
        F.count(F.lit(1)).alias("total_matches"),
        F.countDistinct("entity_id").alias("total_sanctions_entities_matched"),
        rnd(mean("match_score"), 2).alias("avg_match_score"),
        rnd(mean(F.when(F.col("match_type") == "FUZZY_MATCH", F.col("match_score"))), 2).alias(
            "avg_fuzzy_match_score"
        ),
    )
    return counts.crossJoin(F.broadcast(totals))  # one row each


def high_risk_alerts(screening: DataFrame) -> DataFrame:
    rank = choose("alert_priority", {"CRITICAL": 1, "HIGH": 2}, 3)
    return (
        screening.where(
            F.col("disposition_recommendation").isin(
                "HARD_BLOCK", "IMMEDIATE_INVESTIGATION", "ENHANCED_DUE_DILIGENCE"
            )
            & F.col("alert_priority").isin("CRITICAL", "HIGH")
        )
        .orderBy(rank, F.desc("combined_risk_score"), F.desc("match_score"))
        .drop("country_match", "sanctions_is_active", "expiry_date")
    )


def exposed_name_pairs(customers: DataFrame, exposed: DataFrame) -> DataFrame:
    """Distinct upper-case names (cf, cl) of customers near those of active exposed persons, with exposed_person_id.

    Near: same family name and first name within 2 edits, or the reverse, or one edit in each, or full names within
    3 edits.
    """
    names = customers.select(
        F.upper("first_name").alias("cf"),
        F.upper("family_name").alias("cl"),
        F.upper(F.concat_ws(" ", "first_name", "family_name")).alias("cn"),
    ).distinct()
    persons = exposed.where("status = 'ACTIVE'").select(
        "exposed_person_id",
        F.upper("first_name").alias("pf"),
        F.upper("last_name").alias("pl"),
        F.upper("full_name").alias("pn"),
    )

    def keep(df):
        return df.select("cf", "cl", "exposed_person_id")

    near_first, near_last = F.levenshtein("cf", "pf", 2) >= 0, F.levenshtein("cl", "pl", 2) >= 0
    # a very common family or first name is split over several tasks
    same_last = keep(salted_join(names, persons.withColumn("cl", F.col("pl")), "cl", near_first, busy=True))
    same_first = keep(salted_join(names, persons.withColumn("cf", F.col("pf")), "cf", near_last, busy=True))
    last_one = edit_pairs(names, "cl", persons, "pl", 1).where("distance = 1").select(F.col("a").alias("cl"), F.col("b").alias("pl"))
    one_each = keep(salted_join(names, last_one.join(persons, "pl"), "cl", F.levenshtein("cf", "pf", 1) == 1, busy=True))
    full = edit_pairs(names, "cn", persons, "pn", 3).select(F.col("a").alias("cn"), F.col("b").alias("pn"))
    # full names are all but unique among the distinct ones
    near_full = keep(names.join(full.join(persons, "pn"), "cn"))
    return same_last.union(same_first).union(one_each).union(near_full).distinct()


def exposed_person_matches(customers: DataFrame, exposed: DataFrame, near: DataFrame) -> DataFrame:
    """Exact and near matches of customers to active exposed persons; ``near`` is what ``exposed_name_pairs`` gives.

    Returns customer_id, match_kind and the person's columns.
    """
    who = customers.select("customer_id", F.upper("first_name").alias("cf"), F.upper("family_name").alias("cl"))
    detail = exposed.where("status = 'ACTIVE'").drop("status")
    exact = salted_join(
        who.withColumn("_name", F.concat_ws(" ", "cf", "cl")), detail.withColumn("_name", F.upper("full_name")), "_name"
    ).select("customer_id", F.lit("EXACT").alias("match_kind"), *detail.columns)
    fuzzy = salted_join(who, near.join(detail, "exposed_person_id"), ["cf", "cl"])
    return exact.unionByName(fuzzy.select("customer_id", F.lit("FUZZY").alias("match_kind"), *detail.columns))


def exposed_match_score(first, family, p_first, p_last, p_full):
    """Accuracy of a near match, from the distances of the name parts."""
    first, family, p_first, p_last, p_full = (F.upper(c(x)) for x in (first, family, p_first, p_last, p_full))
    df, dl = F.levenshtein(first, p_first), F.levenshtein(family, p_last)
    dn = F.levenshtein(F.concat_ws(" ", first, family), p_full)

    def one_side(d):
        return ((df == 0) & (dl == d)) | ((df == d) & (dl == 0))

    return ladder(
        [
            ((df == 1) & (dl == 1), 95.0),
            (one_side(1), 90.0),
            (one_side(2), 85.0),
            (dn <= 3, F.greatest(F.lit(70.0), 100.0 - dn * 10.0)),
        ],
        75.0,
    )


