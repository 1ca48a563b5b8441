"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver tables of one scale-factor directory through
the adapters and runs a library operator over the *whole* tables.  The
matching SQL for an independent engine lives in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import (clamp, percent_text, round_half_up, short_percent_text,
                                 thousands_text)
from riskweave.operators import cube, trigrams
from riskweave.operators import explore as X
from riskweave.operators import indicators as IND
from riskweave.operators import quality as Q
from riskweave.operators import risk as R
from riskweave.operators.aggregates import rate_by_dim
from riskweave.operators.profile import build_profile
from riskweave.plans import adapters as A
from riskweave.plans import flows
from riskweave.session import configure, shared_dir
from riskweave.sources import io, ordered, quarantine, scan, versions
from riskweave.sources.schemas import DRIVER, SCHOOL, ForeignKey, TableSpec

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed values of the exploration queries.
FILTER_BANDS = ("Alto", "Medio")
FILTER_REGIONS = ("AMERICA", "ASIA", "EUROPE")
FILTER_SEGMENTS = ("BUILDING", "HOUSEHOLD", "MACHINERY")
MIN_MISS_RATE = 0.10
SEARCH_TEXT = "  Customer#0000001 "
SEARCH_REGEX = "customer#0000001[2-4]"
# targeting thresholds at which each of the three conditions decides on these tables
TARGET_RISK, TARGET_RATE, TARGET_MARK = 0.30, 0.35, 4.2
# engagement scale at which the clamp of the rate binds on these tables
CLAMP_SCALE = 13.0
SEED = 2026
SCATTER_ROWS = 1000
TOP_AREAS, TOP_DIMS = 20, 15


def _t(spark: SparkSession, sf_dir: str) -> A.Tables:
    configure(spark)
    return A.tables(spark, sf_dir)


def _profile(spark, sf_dir, how: str = "inner") -> DataFrame:
    return flows.profile(_t(spark, sf_dir), how=how)


def _scored(spark, sf_dir, how: str = "inner") -> DataFrame:
    return flows.scored(flows.with_rule_score(_profile(spark, sf_dir, how)))


def _filter_cond():
    return X.extract_predicate(
        isin={"risk_band": FILTER_BANDS, "region": FILTER_REGIONS, "segment": FILTER_SEGMENTS},
        at_least={"miss_rate": MIN_MISS_RATE})


# --------------------------------------------------------------- features
def q_rate_by_entity(spark, sf_dir):
    """Per entity offered / missed totals and the unrounded miss rate."""
    return flows.entity_rates(_t(spark, sf_dir))


def q_rate_by_dim(spark, sf_dir):
    """Miss rate per part type (facts pre-aggregated per part)."""
    t = _t(spark, sf_dir)
    return rate_by_dim(A.lines_by_part(t), A.part_dim(t), "l_partkey", "part_key", "part_type",
                       "missed", "offered", num_total="missed_total", den_total="offered_total",
                       rate="miss_rate", digits=4)


def q_marks(spark, sf_dir):
    """A2, P20: per entity mean mark (2 dp) and count of low marks."""
    return flows.entity_marks(_t(spark, sf_dir))


def q_engagement(spark, sf_dir):
    """A3: per entity views, purchases, clicks."""
    return flows.entity_engagement(_t(spark, sf_dir))


def q_label(spark, sf_dir):
    """Status, last order date, reason and the 1.0/0.0 label."""
    t = _t(spark, sf_dir)
    from riskweave.operators.profile import label
    return label(A.status(t), "status", A.LAPSED, "lapsed_label")


def q_flags(spark, sf_dir):
    """P4a-c, P5: threshold flags and casts of the profile."""
    return _profile(spark, sf_dir).select(
        "entity_id", "lapsed_label", "low_balance", "high_missed", "no_actions",
        "no_purchases", "low_marks")


def q_profile(spark, sf_dir):
    """Wide profile, inner (entities without facts vanish)."""
    return _profile(spark, sf_dir, "inner")


def q_profile_left(spark, sf_dir):
    """Wide profile, left (every entity with a status)."""
    return _profile(spark, sf_dir, "left")


def q_guarded_profile(spark, sf_dir):
    """The wide profile with its declared cardinalities checked in the joins."""
    return flows.profile(_t(spark, sf_dir), check=("entity", "attributes", "dimension", "facts"))


def q_join_violations(spark, sf_dir):
    """Frames as one-row-per-entity declarations: the roles hold them,
    raw events and orders do not."""
    t = _t(spark, sf_dir)
    return Q.cardinality_report({
        "entity": A.entity(t), "status": A.status(t), "engagement": flows.entity_engagement(t),
        "raw_events": t.events.select(F.col("user_id").alias("entity_id")),
        "raw_orders": t.orders.select(F.col("o_custkey").alias("entity_id"))}, "entity_id")


def q_left_fill(spark, sf_dir):
    """Sparse left join of action counts, filled with 0."""
    t = _t(spark, sf_dir)
    return build_profile(A.entity(t), "entity_id", sparse=[flows.entity_actions(t)],
                         fill={"action_count": 0}).select("entity_id", "name", "action_count")


# ------------------------------------------------------------------ scoring
def q_rule_score(spark, sf_dir):
    """Engagement rate and logistic rule score (4 dp)."""
    s = flows.with_rule_score(_profile(spark, sf_dir))
    return s.select("entity_id", round_half_up("engagement_rate", 4).alias("engagement_rate"),
                    round_half_up("risk_raw", 4).alias("risk"))


def q_engagement_clamped(spark, sf_dir):
    """Engagement rate on a scale where some entities reach the clamp."""
    p = _profile(spark, sf_dir, "left")
    rate = clamp((F.col("views") + F.col("purchases")) / F.lit(CLAMP_SCALE) / F.lit(2.0), 0.0, 1.0)
    return p.select("entity_id", rate.alias("rate"), (rate == 1.0).alias("at_limit"))


def q_scored_left(spark, sf_dir):
    """The scored table of every entity with a status; no score
    where a fact is missing."""
    return _scored(spark, sf_dir, "left")


def q_scored(spark, sf_dir):
    """Scored gold table with bands."""
    return _scored(spark, sf_dir)


def q_targeting(spark, sf_dir):
    """Disjunctive targeting rule, on unrounded risk, rate and mark."""
    p = flows.with_rule_score(_profile(spark, sf_dir))
    risk, rate, mark = (F.col("risk_raw") > TARGET_RISK, F.col("miss_rate") > TARGET_RATE,
                        F.col("avg_mark") < TARGET_MARK)
    return p.where(risk | rate | mark).select(
        "entity_id", risk.alias("by_risk"), rate.alias("by_rate"), mark.alias("by_mark"))


def q_split(spark, sf_dir):
    """M2: md5 hash bucket and train/test split of every entity."""
    e = A.entity(_t(spark, sf_dir)).select("entity_id")
    from riskweave.functions import hash_bucket
    return R.hash_split(e.withColumn("bucket", hash_bucket("entity_id")), "entity_id")


def q_auc(spark, sf_dir):
    """M5: exact held-out AUC of the rule score."""
    return R.auc_exact(_test_split(_scored(spark, sf_dir)), "risk", "lapsed_label")


def q_auc_unrounded(spark, sf_dir):
    """M5: exact held-out AUC of the unrounded rule score."""
    p = R.hash_split(flows.with_rule_score(_profile(spark, sf_dir)), "entity_id")
    return R.auc_ranked(p.where(F.col("split") == "test"), "risk_raw", "lapsed_label")


#: What the binned curve of Spark ML's evaluator may be away from the exact AUC
#: (it keeps about 1,000 points).
EVALUATOR_ERROR = 0.001


def q_ml_auc_exact(spark, sf_dir):
    """M4, M5: the evaluator on the fitted model's held-out rows agrees with
    the exact AUC of its unrounded probability."""
    from riskweave.plans.pipeline import fit_model
    data, model = fit_model(_profile(spark, sf_dir))
    test = R.materialize(R.score_model(model, data.where(F.col("split") == "test"), out="risk_raw"))
    # on the probability itself: a margin may tell apart what saturates to 0 or 1
    auc = R.auc_evaluator(test, label="lapsed_label", raw="risk_raw")
    exact = R.auc_ranked(test, "risk_raw", "lapsed_label")
    rows = test.agg(F.count_if(F.col("lapsed_label") == 1).alias("positives"),
                    F.count_if(F.col("lapsed_label") == 0).alias("negatives"))
    near = F.abs(exact.select("auc").scalar() - F.lit(auc)) <= EVALUATOR_ERROR
    # with one class only there is no curve
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    return rows.select("positives", "negatives", both.alias("has_auc"),
                       F.coalesce(near, exact.select("auc").scalar().isNull()).alias("agrees"))


# --------------------------------------------------------------- indicators
def _by_area(s: DataFrame) -> DataFrame:
    return IND.by_group(s, "area", "status", A.LAPSED, "risk", positive_name="lapsed",
                        rate_name="lapsed_rate")


def q_by_area(spark, sf_dir):
    """Per area entities, lapsed, mean risk, lapsed rate."""
    return _by_area(_scored(spark, sf_dir))


def q_reasons(spark, sf_dir):
    """Lapsed entities per reason (NULL is a group)."""
    return IND.reasons(_scored(spark, sf_dir), "status", A.LAPSED, "reason")


def q_reason_share(spark, sf_dir):
    """Share of each reason."""
    return IND.reason_share(q_reasons(spark, sf_dir))


def _test_split(s: DataFrame) -> DataFrame:
    return R.hash_split(s, "entity_id").where(F.col("split") == "test").withColumn(
        "lapsed_label", F.when(F.col("status") == A.LAPSED, 1).otherwise(0))


def q_kpis(spark, sf_dir):
    """KPI row with the held-out AUC of the published score.

    One aggregate on (score unit, split, label) with the rate and mark unit
    sums feeds both the row and the AUC, so the profile is computed once.
    """
    return IND.kpis_with_auc(_scored(spark, sf_dir), "entity_id", "status", A.LAPSED,
                             names={"positives": "lapsed"})


# -------------------------------------------------------------- exploration
def q_facets(spark, sf_dir):
    """Ordered lists of band (descending), region and segment values."""
    return X.facets(_scored(spark, sf_dir), ["risk_band", "region", "segment"],
                    descending=["risk_band"])


def q_volume_cards(spark, sf_dir):
    """The page's volume cards; the population is the manifest's."""
    t = _t(spark, sf_dir)
    made = io.run_manifest({"entities": A.entity(t)}, {"entities_count": "entities"}, seed=SEED)
    return X.volume_cards(_scored(spark, sf_dir), _filter_cond(), made, "entities_count",
                          {"actions": F.col("action_count"), "views": F.col("views")})


def _read_back(path: str, back: DataFrame) -> DataFrame:
    """Checkpoint what was read back, then remove the folder it came from."""
    out = R.materialize(back)
    io.remove(back.sparkSession, path)
    return out


def q_filtered_extract(spark, sf_dir):
    """The filtered extract, exported as headed CSV and read back."""
    from riskweave.plans.pipeline import SCORED_SCHEMA
    path = io.write_csv_extract(_scored(spark, sf_dir).where(_filter_cond()),
                                shared_dir(spark, "extract"))
    return _read_back(path, io.read_csv(spark, path, SCORED_SCHEMA))


def q_filter_share(spark, sf_dir):
    """Rows before / after the filter, share and its text."""
    return X.filter_share(_scored(spark, sf_dir), _filter_cond())


def q_adaptive_params(spark, sf_dir):
    """Population, adaptive top-N and histogram bins."""
    return X.adaptive_params(_scored(spark, sf_dir))


def q_search(spark, sf_dir):
    """Literal search on name, or id equality."""
    return X.search(_scored(spark, sf_dir), SEARCH_TEXT, "name", "entity_id").select(
        "entity_id", "name", "risk", "risk_band")


def q_search_regex(spark, sf_dir):
    """Regular-expression search on name, or id equality."""
    return X.search(_scored(spark, sf_dir), SEARCH_REGEX, "name", "entity_id", regex=True).select(
        "entity_id", "name", "risk", "risk_band")


def q_percent_text(spark, sf_dir):
    """Percent, thousands and fixed-decimal display text."""
    s = _scored(spark, sf_dir)
    return s.select(
        "entity_id",
        short_percent_text("risk").alias("risk_text"),
        short_percent_text("miss_rate").alias("rate_text"),
        percent_text("risk", 1).alias("risk_pct"),
        F.format_string("%.2f", F.col("avg_mark")).alias("mark_text"),
        thousands_text("balance").alias("balance_text"),
        thousands_text(F.col("views") * F.lit(1000)).alias("views_text"))


def _top_entity(spark, sf_dir):
    """Entity of the highest risk (ties: smallest id), as a one-row frame."""
    return X.top_n(_scored(spark, sf_dir), "risk", 1, "entity_id").select("entity_id")


def q_entity_detail(spark, sf_dir):
    """Detail panel of the highest-risk entity: per part, its lines, missed
    lines and mean mark (A9, A10, J7, O5).

    ``by_missed`` and ``by_mark`` are the places in the panel's two charts:
    missed lines descending and mean mark ascending, ties by part.
    """
    t = _t(spark, sf_dir)
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("entity_id"))
    mine = orders.join(F.broadcast(_top_entity(spark, sf_dir)), "entity_id")  # one row
    lines = t.lineitem.join(mine, "l_orderkey")
    agg = lines.groupBy("entity_id", "l_partkey").agg(*flows.detail_aggs())
    return flows.with_part_names(t, agg).withColumns({
        "by_missed": X.place("entity_id", F.desc("total_missed"), "part_key"),
        "by_mark": X.place("entity_id", F.asc("avg_mark"), "part_key")})


def q_entity_lookup(spark, sf_dir):
    """The detail panel of the highest-risk entity from the
    table that is clustered by entity; pages of other entities are not read."""
    from riskweave.plans import pipeline
    t, root = _t(spark, sf_dir), shared_dir(spark, "lookup")
    io.publish(flows.entity_detail(t), root, "gold", "entity_detail", page_rows=pipeline.LOOKUP_PAGE_ROWS,
               sort_by=[F.col("entity_id"), F.col("l_partkey")])
    top = _top_entity(spark, sf_dir).first()  # one row: the chosen entity
    hits, read = scan.run_and_count(pipeline.entity_detail(spark, root, top.entity_id if top else None))
    named = flows.with_part_names(t, hits).withColumns({
        "by_missed": X.place("entity_id", F.desc("total_missed"), "part_key"),
        "by_mark": X.place("entity_id", F.asc("avg_mark"), "part_key"),
        "few_rows_read": F.lit(read <= 4 * pipeline.LOOKUP_PAGE_ROWS)})
    return _read_back(root, named)


def q_search_index(spark, sf_dir):
    """The literal search through the published trigram index; only the
    stretch of the text's rarest trigram is read of it."""
    root, placed = _stored_scores(spark, sf_dir)
    stored = placed.select("entity_id", "name", "risk", "risk_band")
    trigrams.publish_index(stored, root, "names", "name", "entity_id")
    text = SEARCH_TEXT.strip().lower()
    found, read = scan.run_and_count(trigrams.search_index(spark, root, "names", text))
    _, names = trigrams.rarest(spark, root, "names", text)
    by_id = stored.where(F.col("entity_id").cast("string") == F.lit(text)).select(F.col("entity_id").alias("key"))
    keys = found.unionByName(by_id).distinct().withColumnRenamed("key", "entity_id")
    hits = stored.join(keys, "entity_id", "left_semi")
    return _read_back(root, hits.withColumn("few_rows_read", F.lit(read <= names + 4 * trigrams.PAGE_ROWS)))


# -------------------------------------------------------------- page cube
CUBE_FACETS = ("risk_band", "region", "segment")


def _cube(spark, sf_dir) -> DataFrame:
    """The page's cube, as its readers find it: a small published table."""
    s = R.hash_split(_scored(spark, sf_dir), "entity_id")
    return R.materialize(cube.page_cube(
        s, CUBE_FACETS, "risk", "miss_rate", "avg_mark", F.col("status") == A.LAPSED, F.col("split") == "test",
        {"actions": F.col("action_count"), "views": F.col("views")}))


def q_cube_kpis(spark, sf_dir):
    """The KPI row from the cube."""
    return cube.cube_kpis(_cube(spark, sf_dir), {
        "rows": "total_entities", "positives": "lapsed", "score": "avg_risk", "rate": "avg_miss_rate",
        "mark": "avg_mark", "auc": "model_auc"})


def q_cube_hist(spark, sf_dir):
    """The histogram by band from the cube."""
    return X.weighted_histogram(cube.cube_counts(_cube(spark, sf_dir), "risk_band"), "risk", "rows", by="risk_band")


def q_cube_facets(spark, sf_dir):
    """The facet lists from the cube."""
    return cube.cube_facets(_cube(spark, sf_dir), CUBE_FACETS, descending=["risk_band"])


def q_cube_cards(spark, sf_dir):
    """Rows and sums behind the volume cards for the page's filter, from the cube."""
    cond = cube.cube_filter({"risk_band": FILTER_BANDS, "region": FILTER_REGIONS, "segment": FILTER_SEGMENTS},
                            min_step=round(MIN_MISS_RATE * cube.STEPS))
    return cube.cube_sums(_cube(spark, sf_dir), cond, ["actions", "views"])


def q_entity_tables(spark, sf_dir):
    """The detail page's lookup of one entity in five tables, one row per
    table with its rows there, and the headline texts."""
    t = _t(spark, sf_dir)
    narrow = R.materialize(_scored(spark, sf_dir).select("entity_id", "risk", "miss_rate", "avg_mark"))
    top = X.top_n(narrow, "risk", 1, "entity_id").select("entity_id")
    s = narrow.join(top, "entity_id")
    texts = s.select(percent_text("risk", 1).alias("risk_text"), percent_text("miss_rate", 1).alias("rate_text"),
                     F.format_string("%.2f", "avg_mark").alias("mark_text"))
    keyed = {"scores": s.select("entity_id"), "customer": t.customer.select(F.col("c_custkey").alias("entity_id")),
             "orders": t.orders.select(F.col("o_custkey").alias("entity_id")),
             "events": t.events.select(F.col("user_id").alias("entity_id")),
             "actions": A.actions(t).select("entity_id")}
    return X.lookup_counts(keyed, top, "entity_id").withColumns({
        c: texts.select(c).scalar() for c in texts.columns})


def q_entity_detail_all(spark, sf_dir):
    """The same detail table for every entity (whole tables), with part names."""
    t = _t(spark, sf_dir)
    return flows.with_part_names(t, flows.entity_detail(t))


def q_hist(spark, sf_dir):
    """Risk histogram by band with adaptive bins (unfiltered).

    One aggregate on (score, band) is at most a few ten thousand rows; the
    population, the bins and the histogram all come from it.
    """
    s = _scored(spark, sf_dir)
    per = s.groupBy("risk", "risk_band").agg(F.count(F.lit(1)).alias("rows"))
    return X.weighted_histogram(per, "risk", "rows", by="risk_band")


def q_box(spark, sf_dir):
    """Exact box summary of risk per band."""
    return X.box(_scored(spark, sf_dir), "risk", "risk_band")


def _score_counts(spark, sf_dir):
    """Bounded: 10,001 values per band."""
    return R.materialize(X.score_counts(_scored(spark, sf_dir), "risk", "risk_band"))


def q_box_drawn(spark, sf_dir):
    """The box per band as the chart draws it: quartiles, fences, whisker ends, outlier counts."""
    return X.box_drawn(_score_counts(spark, sf_dir), "risk_band")


def q_box_outliers(spark, sf_dir):
    """The points beyond the whiskers."""
    counts = _score_counts(spark, sf_dir)
    return X.box_outliers(counts, X.box_drawn(counts, "risk_band"), "risk_band")


def _top_n_param(s: DataFrame):
    return X.adaptive_params(s).select("top_n").scalar()


def q_top_n(spark, sf_dir):
    """O1: top-N entities by risk (adaptive N, key tie-break), with their place."""
    s = R.materialize(_scored(spark, sf_dir))  # counted and listed: the profile is computed once
    out = X.top_n_of(s, "risk", _top_n_param(s), X.TOP_MOST, "entity_id")
    return out.withColumn("position", X.place(None, F.desc_nulls_last("risk"), "entity_id"))


def q_top_area(spark, sf_dir):
    """O2: top 20 areas by lapsed rate, with their place."""
    top = X.top_n(_by_area(_scored(spark, sf_dir)), "lapsed_rate", TOP_AREAS, "area")
    return top.withColumn("position", X.place(None, F.desc_nulls_last("lapsed_rate"), "area"))


def q_top_dim(spark, sf_dir):
    """O2: top 15 part types by miss rate, with their place."""
    top = X.top_n(q_rate_by_dim(spark, sf_dir), "miss_rate", TOP_DIMS, "part_type")
    return top.withColumn("position", X.place(None, F.desc_nulls_last("miss_rate"), "part_type"))


def _stored_scores(spark, sf_dir):
    """The scored table as the sink stores it, by risk descending (ties: key);
    its folder, and its rows with their file and place."""
    from riskweave.plans.pipeline import SCORED_SCHEMA
    root = shared_dir(spark, "stored-scores")
    paths = io.publish(_scored(spark, sf_dir), root, "gold", "scores",
                       sort_by=[F.col("risk").desc_nulls_last(), F.col("entity_id")])
    return root, ordered.read_placed(spark, paths["parquet"], SCORED_SCHEMA)


def q_stored_order(spark, sf_dir):
    """O1: the stored order, proved from the files: rows that come too early
    inside a file, files that begin too early, and the ends of the list."""
    root, placed = _stored_scores(spark, sf_dir)
    order = F.struct(F.col("risk").isNull(), -F.col("risk"), "entity_id")
    at = F.struct("_file", "_row")
    ends = placed.agg(F.min_by("entity_id", at).alias("first_entity"), F.max_by("entity_id", at).alias("last_entity"))
    proof = ordered.order_proof(placed, order).select("rows", "breaks_inside", "breaks_between")
    return _read_back(root, proof.crossJoin(ends))  # one row each


def q_scatter(spark, sf_dir):
    """O3: the first 1000 filtered entities in stored order, with their place."""
    root, placed = _stored_scores(spark, sf_dir)
    first = ordered.first_in_file_order(placed, SCATTER_ROWS, _filter_cond())
    return _read_back(root, first.select(
        "entity_id", "name", "segment", "region", "area", "risk", "risk_band", "miss_rate",
        "avg_mark", "position"))


def q_priority_list(spark, sf_dir):
    """Priority list of the filtered entities in stored order, with display text and place."""
    root, placed = _stored_scores(spark, sf_dir)
    f = ordered.first_in_file_order(placed, _top_n_param(placed), _filter_cond(), most=X.TOP_MOST)
    return _read_back(root, f.select(
        "entity_id", "name", "segment", "region", "area",
        short_percent_text("risk").alias("risk"), "risk_band",
        short_percent_text("miss_rate").alias("miss_rate"), "avg_mark", "balance",
        "purchases", "action_count", "position"))


# ----------------------------------------------------------------- quality
def _driver_tables(t: A.Tables, names=None) -> dict[str, DataFrame]:
    return {n: getattr(t, n) for n in (names or DRIVER)}


ORDERS_HAVE_LINES = ("orders_have_lines", "orders",
                     ForeignKey(("o_orderkey",), "lineitem", ("l_orderkey",)))


def q_fk_orphans(spark, sf_dir):
    """Orphan keys and rows per foreign key."""
    t = _t(spark, sf_dir)
    return Q.fk_summary(_driver_tables(t), DRIVER, extra=[ORDERS_HAVE_LINES])


def q_pk_violations(spark, sf_dir):
    """Duplicate keys and rows per table."""
    return Q.pk_summary(_driver_tables(_t(spark, sf_dir)), DRIVER)


def q_null_counts(spark, sf_dir):
    """NULLs per declared NOT NULL column, and per fact column of the
    left profile (where they do occur)."""
    tables = Q.null_summary(_driver_tables(_t(spark, sf_dir)), DRIVER)
    facts = ["miss_rate", "avg_mark", "views", "purchases", "action_count", "reason"]
    return tables.unionByName(Q.null_counts(_profile(spark, sf_dir, "left"), facts, "profile_left"))


def q_fk_event_users(spark, sf_dir):
    """Orphans of a check that these tables break: events whose type is
    no order priority, and active users without a purchase."""
    t = _t(spark, sf_dir)
    et = F.col("event_type")
    frames = {"views": t.events.where(et == "view").select("user_id"),
              "buyers": t.events.where(et == "purchase").select("user_id"),
              "orders": t.orders.select("o_custkey")}
    none = {n: TableSpec(n, f.schema) for n, f in frames.items()}
    return Q.fk_summary(frames, none, extra=[
        ("viewers_buy", "views", ForeignKey(("user_id",), "buyers", ("user_id",))),
        ("buyers_order", "buyers", ForeignKey(("user_id",), "orders", ("o_custkey",))),
        ("customers_view", "orders", ForeignKey(("o_custkey",), "views", ("user_id",)))])


# ---------------------------------------------------------------------- io
def q_csv_roundtrip(spark, sf_dir):
    """Publish the scored table as CSV alone and read it back."""
    from riskweave.plans.pipeline import SCORED_SCHEMA
    root = shared_dir(spark, "csv-roundtrip")
    io.publish(_scored(spark, sf_dir), root, "gold", "scored", formats=("csv",))
    return _read_back(root, io.read_dataset(spark, root, "gold", "scored", fmt="csv", schema=SCORED_SCHEMA))


def q_parquet_roundtrip(spark, sf_dir):
    """Publish the silver profile as parquet over an older dataset (S14) and read it back."""
    root = shared_dir(spark, "parquet-roundtrip")
    p = _profile(spark, sf_dir)
    io.publish(_t(spark, sf_dir).region, root, "silver", "profile")
    io.publish(p, root, "silver", "profile")  # full refresh: nothing of the first stays
    return _read_back(root, io.read_dataset(spark, root, "silver", "profile"))


def q_publish_run(spark, sf_dir):
    """The layered publish run (silver + gold, parquet + CSV) into
    the shared folder; rows of every dataset in each of its formats, read back."""
    from riskweave.plans.pipeline import published_counts, run
    root = shared_dir(spark, "publish")
    run(spark, sf_dir, root, method="rule")
    return _read_back(root, published_counts(spark, root))


OPTIONAL_TABLES = ("customer", "orders", "events", "interventions", "guardians")


def q_optional_source(spark, sf_dir):
    """Row counts, missing optional tables as empty."""
    frames = {}
    for name in OPTIONAL_TABLES:
        sch = (DRIVER.get(name) or SCHOOL[name]).schema
        frames[name] = io.read_table(spark, sf_dir, name, on_missing="empty", schema=sch)
    return io.table_counts(frames)


MANIFEST_FIELDS = ("entities_count", "activity_rows", "marks_rows", "engagement_rows", "actions_rows")


def q_run_manifest(spark, sf_dir):
    """Run manifest written as JSON and read back.  Its counts are
    taken by the writes of the tables; each is read once."""
    t, root = _t(spark, sf_dir), shared_dir(spark, "manifest")
    made = io.write_counted(A.entity(t), root, "bronze", "entities")
    facts = io.write_counted(A.order_facts(t), root, "bronze", "order_facts", {
        "activity": F.count(F.lit(1)), "marks": F.count_if(F.col("n_lines") > 0), "actions": F.sum("urgent")})
    clicks = io.write_counted(A.engagement(t), root, "bronze", "engagement")
    counts = {"entities_count": made["rows"], "activity_rows": facts["activity"], "marks_rows": facts["marks"],
              "engagement_rows": clicks["rows"], "actions_rows": facts["actions"]}
    io.write_manifest(io.manifest_of(spark, counts, seed=SEED), f"{root}/manifest")
    return _read_back(root, io.read_manifest(spark, f"{root}/manifest")).select(*MANIFEST_FIELDS, "seed")


def q_skip_empty(spark, sf_dir):
    """Tables written with their counts; an empty one leaves no dataset."""
    root, rows = shared_dir(spark, "skip-empty"), []
    for name in OPTIONAL_TABLES:
        sch = (DRIVER.get(name) or SCHOOL[name]).schema
        table = io.read_table(spark, sf_dir, name, on_missing="empty", schema=sch)
        n = io.write_counted(table, root, "bronze", name)["rows"]
        back = io.read_table(spark, root, name, on_missing="empty", schema=sch,
                             path=io.dataset_path(root, "bronze", name, "parquet"))
        stored = io.exists(spark, io.dataset_path(root, "bronze", name, "parquet"))
        rows.append(back.agg(F.count(F.lit(1)).alias("read_back")).select(
            F.lit(name).alias("table_name"), F.lit(n).cast("long").alias("counted"), "read_back", F.lit(stored).alias("stored")))
    return _read_back(root, reduce(DataFrame.unionByName, rows))


def q_refresh_versions(spark, sf_dir):
    """Two refreshes and one that dies half-way; rows of every
    dataset in each version that was committed, and the one that readers see."""
    t, root = _t(spark, sf_dir), shared_dir(spark, "refresh")

    def write(how: str, dies: bool = False):
        def run(folder: str) -> dict:
            prof = flows.profile(t, how=how)
            n = io.write_counted(prof, folder, "silver", "profile")["rows"]
            if dies:
                raise InterruptedError("half-way")
            areas = io.read_dataset(spark, folder, "silver", "profile").groupBy("region", "area").agg(
                F.count(F.lit(1)).alias("entities"))
            return {"profile": n, "areas": io.write_counted(areas, folder, "gold", "areas")["rows"]}
        return run

    versions.refresh(spark, root, write("inner"))
    versions.refresh(spark, root, write("left"))
    try:
        versions.refresh(spark, root, write("inner", dies=True))
    except InterruptedError:
        pass
    now = versions.current(spark, root).number
    rows = [io.read_dataset(spark, v.path, layer, name).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(v.number).cast("long").alias("version"), F.lit(v.number == now).alias("is_current"),
                F.lit(name).alias("dataset"), "rows", F.lit(v.facts[name]).cast("long").alias("counted"))
            for v in versions.commits(spark, root) for layer, name in (("silver", "profile"), ("gold", "areas"))]
    return _read_back(root, reduce(DataFrame.unionByName, rows))


#: Where q_quarantine spoils a customer's line: key divisible by, and how.
SPOILED = {97: "balance", 89: "more", 83: "fewer"}


def q_quarantine(spark, sf_dir):
    """Customers written as CSV with spoiled lines, loaded with the bad
    rows set aside; rows per reason and the sums of what was loaded."""
    t, root = _t(spark, sf_dir), shared_dir(spark, "quarantine")
    schema = DRIVER["customer"].schema
    key, fields = F.col("c_custkey"), [F.col(f.name).cast("string") for f in schema.fields]
    spoil = {how: key % n == 0 for n, how in SPOILED.items()}
    bad_balance = [F.lit("none") if f.name == "c_acctbal" else c for f, c in zip(schema.fields, fields)]
    line = (F.when(spoil["balance"], F.concat_ws(",", *bad_balance))
            .when(spoil["more"], F.concat_ws(",", *fields, F.lit("extra")))
            .when(spoil["fewer"], F.concat_ws(",", *fields[:-1])).otherwise(F.concat_ws(",", *fields)))
    t.customer.select(line.alias("line")).write.text(f"{root}/csv")
    loaded = quarantine.load_csv(spark, f"{root}/csv", schema, f"{root}/loaded", header=False)
    good = loaded.good.agg(F.lit("loaded").alias("reason"), F.count(F.lit(1)).alias("rows"),
                           F.sum("c_custkey").alias("keys"))
    raw_key = F.substring_index("raw", ",", 1).cast("long")
    bad = loaded.bad.where("file is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("rows"), F.sum(raw_key).alias("keys"))
    return _read_back(root, good.unionByName(bad))


# ---------------------------------------------------------------------- ML
def q_ml_split(spark, sf_dir):
    """M1, M2, M6, M7: the entities that the fitted model scores, with their split."""
    scored, _ = _model_run(spark, sf_dir)
    return scored.select("entity_id", "split", F.col("risk").between(0.0, 1.0).alias("is_probability"))


def q_ml_calibration(spark, sf_dir):
    """On its training rows an unregularised logistic fit with an
    intercept has the residual sums 0: the mean probability equals the
    positive share (4 digits), and each feature's residual moment vanishes
    (relative to the feature's mean, 3 digits)."""
    data, model = _fit(spark, sf_dir)
    return R.score_equations(model, data.where(F.col("split") == "train"), flows.MODEL_FEATURES, "lapsed_label")


def _fit(spark, sf_dir):
    from riskweave.plans.pipeline import fit_model
    return fit_model(_profile(spark, sf_dir), max_iter=500, tol=1e-12)


def _model_run(spark, sf_dir):
    from riskweave.plans.pipeline import fit_and_score
    return fit_and_score(_profile(spark, sf_dir))


def q_ml_scores(spark, sf_dir):
    """Logistic model scores for every entity."""
    scored, _ = _model_run(spark, sf_dir)
    return scored.select("entity_id", "split", "risk", "risk_band")


def q_ml_auc(spark, sf_dir):
    """M4, M5: evaluator AUC, and the AUC of the published score, on the held-out split."""
    scored, auc = _model_run(spark, sf_dir)
    test = scored.where(F.col("split") == "test")
    exact = R.auc_exact(test, "risk", "lapsed_label", out="auc_published")
    return exact.select(F.lit(round(auc, 6)).alias("auc_evaluator"), "auc_published")


QUERIES: dict[str, QueryFn] = {
    name: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)
}
