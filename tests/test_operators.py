"""Operators against brute force on small fixtures, with hot keys."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bureaulake import catalog
from bureaulake.functions import accounts as acc
from bureaulake.ml import forest
from bureaulake.operators import batches, features, imputation, metrics, monitoring, privacy, profile, ranking, registry, reports
from bureaulake.plans import facts
from bureaulake.sources import files, scratch, views


def test_row_numbers_with_a_hot_key(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(6)
    got = {(r["k"], r["v"]): r["n"] for r in ranking.row_number_in_buckets(df, ["k"], F.floor(F.col("v") / 100), [F.col("v")], "n").collect()}
    seen: dict = {}
    for k, v in sorted(rows, key=lambda r: r[1]):
        seen[k] = seen.get(k, 0) + 1
        assert got[(k, v)] == seen[k]
    assert len(got) == len(rows)


def test_split_is_exact_and_reproducible(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    first, again = [ranking.split_labels(d, ["y"], F.md5(F.col("id").cast("string"))) for d in (df, df.repartition(9))]
    assert {tuple(r) for r in first.select("id", "split").collect()} == {tuple(r) for r in again.select("id", "split").collect()}
    counts = {(r["y"], r["split"]): r["count"] for r in first.groupBy("y", "split").count().collect()}
    assert counts == {(0, "train"): 630, (0, "validation"): 135, (0, "holdout"): 135, (1, "train"): 70, (1, "validation"): 15, (1, "holdout"): 15}


def test_hash_sample_takes_the_smallest_digests(spark):
    df = spark.range(5000).withColumn("h", F.md5(F.col("id").cast("string")))
    want = {r["id"] for r in df.orderBy("h").limit(100).collect()}
    assert {r["id"] for r in ranking.hash_sample(df, F.col("h"), 100).collect()} == want


def test_smallest_per_group(spark):
    df = spark.range(4000).select((F.col("id") % 2).alias("g"), "id", F.lit(1.0).alias("v"))
    got = profile.smallest_per_group(df, ["g"], "id", ["v"], 100)
    assert sorted(r["id"] for r in got.collect()) == list(range(200))


def test_auc_matches_pair_counting(spark):
    rng = random.Random(7)
    rows = [(rng.randint(0, 1), rng.choice([0.0, 0.1, 0.25, 0.5, 0.500001, 0.9, 1.0])) for _ in range(300)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = metrics.auc(spark.createDataFrame(rows, "label int, score double"), []).first()["auc"]
    assert got == pytest.approx(want)


def _streak(histories):
    """Months on time before the first other code over all histories in order."""
    n = 0
    for codes in histories:
        for code in codes:
            if code != "0":
                return n
            n += 1
    return n


def test_streak_runs_over_histories_and_never_reopens(spark):
    rng = random.Random(3)
    people = {i: [[rng.choice(["0"] * 30 + ["#", "2", ""]) for _ in range(24)] for _ in range(rng.randint(1, 4))] for i in range(60)}
    people[99] = [["0"] * 24, ["0"] * 24]
    rows = [(i, p + 1, codes) for i, hs in people.items() for p, codes in enumerate(hs)]
    got = facts.payment_facts(spark.createDataFrame(rows, "applicant_id long, position int, codes array<string>")).collect()
    for r in got:
        hs = people[r["applicant_id"]]
        flat = [c for codes in hs for c in codes]
        assert (r["current_streak"], r["months_on_time"], r["worst_month"]) == (_streak(hs), flat.count("0"), 2 if "2" in flat else 0)


def test_default_flag_order_and_ambiguity(spark):
    cases = {1: [("D", 0, 5), ("W", 0, 1)], 2: [("RV", 0, 2), ("E", 0, 1)], 3: [("A", 3, 1)], 4: [("A", 1, 1), ("", 0, 2)],
             5: [("A", 1, 1), ("C", 0, 2)], 6: [("A", 2, 1), ("Q", 0, 2)], 7: [("x", 0, 1)]}
    rows = [(i, *r) for i, rs in cases.items() for r in rs]
    df = spark.createDataFrame(rows, "i int, code string, arrears int, pos long")
    agg = df.groupBy("i").agg(*[s.alias(n) for n, s in acc.default_signals(F.col("code"), F.col("arrears"), F.col("pos")).items()])
    got = {r["i"]: (r["f"], r["x"]) for r in agg.select("i", acc.default_flag().alias("f"), acc.default_exclusion().alias("x")).collect()}
    assert got == {1: (None, "EXCLUDED_STATUS_D"), 2: (None, "EXCLUDED_STATUS_E"), 3: (1, None), 4: (None, "AMBIGUOUS_ACTIVE_1_2_ARREARS"),
                   5: (0, None), 6: (0, None), 7: (1, None)}


def test_enquiries_keep_product_45_first(spark):
    rows = [(1, 49, 1, "E1", "2024-01-01", "b"), (1, 45, 9, "E1", "2024-02-01", "a"), (1, 45, 2, None, "2024-03-01 10:00", "Lender "),
            (1, 49, 3, " ", "2024-03-01", "lender"), (2, 49, 1, "E1", "2024-01-01", "b")]
    df = spark.createDataFrame(rows, "applicant_id long, source int, position long, enquiry_id string, date_requested string, subscriber string")
    got = {(r["applicant_id"], r["enquiry_key"]): (r["source"], r["position"]) for r in facts.merged_enquiries(df).collect()}
    assert got == {(1, "id|E1"): (45, 9), (1, "fb|2024-03-01|lender"): (45, 2), (2, "id|E1"): (49, 1)}


def test_nested_and_relational_paths_agree(spark, sf_dir):
    """The same bureau data as nested reports and as tables give the same thirty features."""
    def text(c):
        return F.col(c).cast("string")

    money = lambda c: F.concat(F.format_number(F.col(c), 4), F.lit(" "))
    table_facts = facts.applicant_facts(spark, sf_dir).cache()
    people = views.applicants(spark, sf_dir)
    rows = views.accounts(spark, sf_dir)
    agreement = F.struct(F.col("status_code").alias("accountStatusCode"), text("months_in_arrears").alias("monthsInArrears"),
                         text("opening_balance").alias("openingBalanceAmt"), text("current_balance").alias("currentBalanceAmt"),
                         F.col("date_opened").alias("dateAccountOpened"), F.col("closed_date").alias("closedDate"), F.col("account_type").alias("accountType"))
    by_person = rows.groupBy("applicant_id").agg(
        F.collect_list(F.when(F.col("in_45"), agreement)).alias("agreements"),
        F.collect_list(F.when(F.col("in_49"), agreement)).alias("facilities"),
        F.collect_list(F.when(F.col("in_45"), F.struct("address"))).alias("addresses"))
    codes = views.payment_histories(spark, sf_dir).select(
        "applicant_id", F.struct(*[F.get("codes", F.lit(m)).alias(f"m{m + 1:02d}") for m in range(24)]).alias("history"))
    asked = F.struct(F.col("enquiry_id").alias("subscriberEnquiryResultID"), F.col("date_requested").alias("dateRequested"), F.col("subscriber").alias("subscriberName"))
    enquiries = views.enquiries(spark, sf_dir).groupBy("applicant_id").agg(
        F.collect_list(F.when(F.col("source") == 45, asked)).alias("e45"), F.collect_list(F.when(F.col("source") == 49, asked)).alias("e49"))
    amounts = table_facts.select("applicant_id", "outstanding_debt", F.col("instalment_45").alias("i45"), "arrear_amount", "accounts_in_arrear",
                                 "active_accounts", "total_accounts", F.col("mobile_max").alias("mm"))
    joined = (people.join(amounts, "applicant_id").join(by_person, "applicant_id", "left").join(codes, "applicant_id", "left")
              .join(enquiries, "applicant_id", "left"))
    personal = F.struct(F.col("birth_date").alias("birthDate"), "dependants", F.col("employer").alias("employerDetail"), F.col("national_id").alias("nationalIDNo"))
    rating = F.struct(F.col("delinquency_raw").alias("highestDelinquencyRating"))
    report_45 = F.struct(
        F.struct(F.col("status_45").alias("statusCode")).alias("response"), personal.alias("personalDetailsSummary"), rating.alias("highestDelinquencyRating"),
        F.struct(money("outstanding_debt").alias("totalOutstandingdebtGHS"), money("i45").alias("totalMonthlyInstalmentGHS"),
                 text("active_accounts").alias("totalActiveAccountsGHS"), text("total_accounts").alias("totalNumberofAccountsGHS"),
                 text("bounced_cheques").alias("totalNumberofDishonouredGHS"), text("accounts_in_arrear").alias("totalAccountInArrearGHS"),
                 money("arrear_amount").alias("totalAmountInArrearGHS")).alias("creditAccountSummary"),
        F.coalesce("agreements", F.array()).alias("creditAgreementSummary"), F.array_compact(F.array("history")).alias("accountMonthlyPaymentHistory"),
        F.col("e45").alias("enquiryHistory"), F.when(F.col("judgement_found"), F.array(F.lit("j"))).otherwise(F.array().cast("array<string>")).alias("judgementSummary"),
        F.when(F.col("has_adverse"), F.array(F.lit("d"))).alias("defaults"), F.col("addresses").alias("addressHistory"))
    report_49 = F.struct(
        F.struct(F.col("status_49").alias("statusCode")).alias("response"), personal.alias("personalDetailsSummary"), rating.alias("highestDelinquencyRating"),
        F.coalesce("facilities", F.array()).alias("detailedFacilityInfo"),
        F.struct(money("mm").alias("highestAmountTaken"), text("instalment_49").alias("totalMonthlyInstalment")).alias("creditAccountSummary"),
        F.col("e49").alias("enquiryHistory"))
    lines = joined.select("request_id", F.to_json(F.struct(report_45.alias("consumer_full_report_45"), report_49.alias("consumer_mobile_report_49"))).alias("json"))
    parsed = lines.select("request_id", F.from_json("json", reports.PAYLOAD).alias("raw"))
    nested = features.feature_vector(reports.facts(parsed.select("request_id", reports.normalise(F.col("raw")).alias("payload"))))
    flat = features.feature_vector(table_facts)

    def collected(df):
        return {r["request_id"]: tuple(r) for r in df.select("request_id", "hit_status", *catalog.FEATURES).collect()}

    assert collected(nested) == collected(flat)


def test_imputation_leaves_no_gap_it_has_a_rule_for(spark, sf_dir):
    vectors = facts.feature_table(spark, sf_dir, impute=False)
    filled = imputation.impute(vectors, imputation.parameters(vectors))
    gaps = filled.agg(*[F.count_if(F.col(f).isNull() | F.isnan(f)).alias(f) for f in catalog.IMPUTABLE]).first()
    assert not any(gaps)


def test_live_contract_updates_only_real_moves(spark):
    new = spark.createDataFrame([("a", "MEDIAN", 0.6), ("b", "MEDIAN", 0.52), ("c", "MEDIAN", None), ("z", "ZERO", 0.9)], "feature string, strategy string, value double")
    old = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", 0.5)], "feature string, value double")
    got = {r["feature"]: (r["updated"], r["value"]) for r in imputation.live_contract(new, old).collect()}
    assert got == {"a": (True, 0.6), "b": (False, 0.5), "c": (False, 0.5)}


def test_psi_of_equal_tables_is_zero_and_small_features_are_left_out(spark):
    rows = [("f", b, 20) for b in range(5)] + [("g", 0, 9)]
    h = spark.createDataFrame(rows, "feature string, bin int, n long")
    got = monitoring.psi(h, h).collect()
    assert [(r["feature"], r["psi"], r["severity"]) for r in got] == [("f", 0.0, "NONE")]


def test_fairness_needs_enough_rows(spark):
    rows = [("YOUNG", 1, 1)] * 20 + [("PRIME", 1, 0)] * 10 + [("PRIME", 0, 1)] * 10 + [("SENIOR", 1, 0)] * 4 + [("UNKNOWN", 1, 0)] * 50
    groups = monitoring.group_table(spark.createDataFrame(rows, "age_group string, actual int, predicted int"))
    report = monitoring.fairness_report(groups).first()
    assert (report["di_ratio"], report["max_gap"], report["violations"], report["passed"]) == (0.5, 1.0, 2, False)


def test_masking_is_deterministic_and_whole(spark):
    df = spark.createDataFrame([(i, f"Name {i % 7}", f"u{i}@x.org", " " if i % 5 == 0 else "Main St") for i in range(100)], "id int, full_name string, email string, street string")
    methods = {"full_name": "tokenize", "email": "hash", "street": "generalize"}
    first, again = [{tuple(r) for r in privacy.mask(d, methods, "s").select("id", "full_name", "email", "street").collect()} for d in (df, df.repartition(5))]
    assert first == again and len(first) == 100
    assert len({r[1] for r in first}) == 7 and all(len(r[2]) == 16 for r in first) and {r[3] for r in first} == {" ", "[LOCATION]"}
    other = {r["email"] for r in privacy.mask(df, {"email": "hash"}, "t").collect()}
    assert not other & {r[2] for r in first}


def test_column_words_respect_underscores(column):
    assert column(privacy.column_category, ["email", "customer_name", "my national_id", "nameless", "customerEmail", "zip"], "string") == [
        "emails", "names", "ids", None, None, "addresses"]


def test_line_numbers_over_many_splits(spark, tmp_path):
    path = tmp_path / "lines.txt"
    lines = [f"row {i}" if i % 4 else "  " for i in range(5000)]
    path.write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        numbered = batches.number_lines(files.read_lines(spark, str(path)))
        got = {r["line_no"]: r["line"] for r in numbered.collect()}
        assert files.read_lines(spark, str(path)).rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {n: s for n, s in enumerate([s.strip() for s in lines if s.strip()], start=1)}


def test_checksums_and_outcomes(spark, tmp_path):
    import hashlib

    for name, body in (("a.bin", b"x" * 100_000), ("b.bin", b"\x00\x01" * 500)):
        (tmp_path / name).write_bytes(body)
    probed = files.probe(files.list_files(spark, str(tmp_path), "*.bin"), checksum=True)
    got = {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in probed.collect()}
    assert got == {n: hashlib.sha256((tmp_path / n).read_bytes()).hexdigest() for n in ("a.bin", "b.bin")}
    kinds = {r["path"].rsplit("/", 1)[1]: r["is_binary"] for r in files.introspect(probed).collect()}
    assert kinds == {"a.bin": False, "b.bin": True}


def test_newest_decision_within_thirty_days(spark):
    import datetime as dt

    day = dt.date(2024, 1, 1)
    rng = random.Random(5)
    audit = [("hot" if i % 3 else f"r{i % 20}", day + dt.timedelta(days=rng.randint(0, 90)), i, "APPROVE") for i in range(400)]
    asks = [(rid, day + dt.timedelta(days=d)) for rid in ("hot", "r3", "r6", "none") for d in (0, 20, 60, 119)]
    got = {(r["request_id"], r["asked_on"]): r["audit_id"] for r in registry.visible_decisions(
        spark.createDataFrame(audit, "request_id string, decision_date date, audit_id long, decision string"),
        spark.createDataFrame(asks, "request_id string, asked_on date")).collect()}
    for rid, asked in asks:
        seen = [(d, i) for r, d, i, _ in audit if r == rid and asked - dt.timedelta(days=30) <= d <= asked]
        assert got[(rid, asked)] == (max(seen)[1] if seen else None)


def test_append_is_idempotent(spark):
    keys = ["request_id", "kind"]
    rows = spark.createDataFrame([("a", "d"), ("a", "d"), ("a", "e"), ("b", "d")], "request_id string, kind string")
    path = scratch.folder(spark, "append-test")
    registry.not_yet_stored(rows, rows.limit(0), keys).write.parquet(path)
    for _ in range(2):
        registry.not_yet_stored(rows, spark.read.parquet(path), keys).write.mode("append").parquet(path)
    assert spark.read.parquet(path).count() == 3


def test_isolation_forest_finds_the_odd_row(spark):
    rng = np.random.default_rng(1)
    rows = [(f"r{i}", *[float(v) for v in rng.normal(0.5, 0.02, 30)]) for i in range(400)] + [("odd", *[3.0] * 30)]
    df = spark.createDataFrame(rows, "request_id string, " + ", ".join(f"{f} double" for f in catalog.FEATURES))
    nodes = forest.fit(df, trees=40, sample=128)
    scores = {r["request_id"]: r["anomaly_raw"] for r in forest.score(df, nodes, sample=128).collect()}
    assert len(scores) == 401 and min(scores, key=scores.get) == "odd" and all(-1 <= s < 0 for s in scores.values())
    assert nodes.groupBy("tree").agg(F.sum(F.when(F.col("feature") < 0, F.col("size"))).alias("n")).filter("n <> 128").count() == 0


def test_csv_keeps_short_lines_and_drops_long_ones(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n")
    got = files.read_delimited(spark, str(tmp_path), ["a", "b", "c"]).collect()
    assert [tuple(r) for r in got] == [("1", "2", "3"), ("4", "5", None)]


def test_quantiles_match_interpolation(spark):
    rng = np.random.default_rng(2)
    data = {"flat": np.full(50, 3.0), "skewed": np.concatenate([np.full(400, 1.0), rng.exponential(50.0, 333)]), "one": np.array([7.5])}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("flat", None)]
    got = ranking.quantiles(spark.createDataFrame(rows, "k string, value double"), ["k"], [0.01, 0.5, 0.95], buckets=16).collect()
    assert len(got) == 9
    for r in got:
        assert r["quantile"] == pytest.approx(np.percentile(data[r["k"]], r["share"] * 100))
