"""Hand-written rows for each semantic trap."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimloom.config import schemas
from claimloom.config.rules import BRANCH_DIVISIONS
from claimloom.config.tables import DELTA, SNAPSHOT, TableSpec, catalog
from claimloom.config.vocabulary import CODE_VOCABULARY, TEXT_VOCABULARY
from claimloom.functions import casts, dates, text
from claimloom.operators import classify, curate, documents, features, fx, incremental, lookups, metrics, models, series
from claimloom.session import work_path
from claimloom.sources import readers, sinks, versions


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def invoice(**values):
    names = set(curate.CURATED_COLUMNS)
    base = dict.fromkeys(names, "1") | {c: "02-01-2020" for c in curate.DATE_COLUMNS}
    return base | {"country_code": "FR", "product_name": "Motor", "sell_to_name": "sold", "customer_name": "cust"} | values


def test_curated_invoices(spark):
    raw = [
        invoice(document_num="a", product_name=" Liability "),
        invoice(document_num="b", product_name=None),
        invoice(document_num="c", payment_date=None),
        invoice(document_num="d", country_code="AU", product_name=" Domestic "),
        invoice(document_num="e", country_code="AU", product_name="Commercial - Retail"),
        invoice(document_num="f", country_code="UK", product_name="Anything"),
        invoice(document_num="g", country_code="DE", product_name=" A b\tc "),
        invoice(document_num="h", invoice_fee="-12.5", invoice_amt="-3"),
    ]
    names = sorted(raw[0])
    df = spark.createDataFrame([[r[n] for n in names] for r in raw], ", ".join(f"{n} string" for n in names))
    got = curate.curate_invoices(df)
    assert got.columns == curate.CURATED_COLUMNS and len(got.columns) == 31
    assert rows(got, "document_num", "product_name", "customer_name") == [
        ("d", "PropertyResidential", "cust"),
        ("e", "PropertyCommercial", "cust"),
        ("f", "PropertyCommercial", "sold"),
        ("g", "Abc", "cust"),
        ("h", "Motor", "cust"),
    ]
    h = got.filter("document_num = 'h'").first()
    assert (h.invoice_fee, h.invoice_amt, h.payment_date) == (Decimal("12.5"), Decimal(-3), date(2020, 1, 2))
    bad = df.filter("document_num = 'h'").withColumns({"invoice_cost": F.lit("x"), "creation_date": F.lit("2020")})
    tolerant = curate.curate_invoices(bad, on_error="null").first()
    assert tolerant.invoice_cost is None and tolerant.creation_date is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        curate.curate_invoices(bad).collect()
    assert rows(curate.invoice_countries(df), "country_code") == [("AU",), ("DE",), ("FR",), ("UK",)]
    assert curate.curate_invoices(df, countries=["AU"]).count() == 2


def test_branch_rules(spark):
    cases = {
        "25CAT": ("New South Wales", "CCS"),
        "XSTRATAE": ("STRATA", "CCS"),  # also ends in E: the earlier rule wins
        "CEG1": ("Construction & Engineering", "GTS"),
        "MB6E": ("Western Australia", "CCS"),  # in the list before the suffix rule
        "XYE": ("Licensee", "CCS"),
        "0000": ("Head office", "SS"),  # mapping ignores case
        "TPA1": ("TPA", "TPA"),  # no second mapping: passes through
        "BVL9": ("Building Validation", "Building Validation"),
        "ZZZ9": ("Other", "ZZZ9"),
    }
    df = spark.createDataFrame([(b,) for b in cases] + [("ZZZ9",), (None,)], "branch string")
    got = classify.branch_lines(df, "branch")
    expected = [(b, d, s, 2 if b == "ZZZ9" else 1) for b, (d, s) in cases.items()] + [(None, "Other", None, None)]
    assert rows(got, "branch", "division", "service_line", "frequency") == sorted(expected, key=str)
    assert len(BRANCH_DIVISIONS) == 51


RATES = "effdt date, from_cur string, to_cur string, rate_mult decimal(15,8), rate_div decimal(15,8)"
HISTORY = "effdt string, aud_usd_div decimal(15,8), usd_eur_mul decimal(15,8)"


def test_fx(spark):
    one, two, three = Decimal("1.5"), Decimal("0.9"), Decimal("7")
    day = date(2020, 1, 4)
    aud, eur = (day, " AUD", "USD ", three, one), (day, "USD", "EUR", two, three)
    history = spark.createDataFrame([("12/31/2018", three, three), ("01/02/2019", one, None)], HISTORY)

    def latest(*rates):
        return rows(fx.fx_latest(spark.createDataFrame(list(rates), RATES), history, "2020-01-05"), "*")

    assert latest(aud, eur) == [("01/04/2020", one, two)]
    assert latest(aud) == [("01/04/2020", one, None)]  # second leg missing: null, fresh row still wins
    assert latest(eur) == [("01/04/2020", one, None)]  # first leg missing: newest stored row by date
    no_history = spark.createDataFrame([], HISTORY)
    assert fx.fx_latest(spark.createDataFrame([eur], RATES), no_history, "2020-01-05").isEmpty()


def test_weekly_series(spark):
    data = [
        ("A", date(2020, 1, 5), Decimal(1)),  # a Sunday ends its own week
        ("A", date(2020, 1, 6), Decimal(2)),  # Monday: next Sunday
        ("A", date(2020, 1, 27), Decimal(4)),
        ("A", date(2020, 1, 1), Decimal(100)),  # the bound itself is excluded
        ("A", None, Decimal(100)),
        ("A", date(2020, 1, 7), None),
        ("B", date(2020, 3, 30), Decimal(3)),
    ]
    df = spark.createDataFrame(data, "region string, day date, y decimal(18,2)")
    weeks = series.weekly_series(df, ["region"], "day", "y", after="2020-01-01")
    assert rows(weeks, "region", F.col("ds").cast("string"), F.col("y").cast("int")) == [
        ("A", "2020-01-05", 1),
        ("A", "2020-01-12", 2),
        ("A", "2020-01-19", 0),
        ("A", "2020-01-26", 0),
        ("A", "2020-02-02", 4),
        ("B", "2020-04-05", 3),
    ]
    horizon = series.fiscal_horizon(weeks, ["region"])
    assert rows(horizon, "region", "periods") == [("A", 8), ("B", 51)]
    ahead = series.future_weeks(horizon, ["region"])
    assert ahead.groupBy("region").agg(F.max("ds")).filter("region = 'A'").first()[1] == date(2020, 3, 29)
    assert series.future_weeks(horizon, ["region"], weeks).count() == 6 + 8 + 51
    assert series.future_weeks(spark.createDataFrame([("C", date(2020, 3, 29), 0)], horizon.schema), ["region"]).isEmpty()


def test_dates_and_casts(spark):
    first = spark.createDataFrame([("02-01-2020",), ("5-1-2020",), (None,)], "d string")
    assert {r.d for r in dates.parse_date_column(first, "d").collect()} == {date(2020, 1, 2), date(2020, 1, 5), None}
    second = spark.createDataFrame([("2020-01-02",), ("2020-1-5",)], "d string")
    assert {r.d for r in dates.parse_date_column(second, "d").collect()} == {date(2020, 1, 2), date(2020, 1, 5)}
    mixed = spark.createDataFrame([("02-01-2020",), ("2020-01-05",)], "d string")
    with pytest.raises(Exception, match="CANNOT_PARSE"):
        dates.parse_date_column(mixed, "d").collect()
    numbers = spark.createDataFrame([("1.5", "7"), ("x", "y"), (None, None)], "a string, b string")
    types = {"a": "double", "b": "bigint"}
    assert {tuple(r) for r in casts.cast_columns(numbers, types, "null").collect()} == {(1.5, 7), (None, None)}
    assert tuple(casts.cast_failures(numbers, types).first()) == (1, 1)
    assert dates.parse_dates(second, ["d"], "yyyy-M-d").first().d == date(2020, 1, 2)


def test_text(spark):
    values = ["no longer leaking, wet <1 day", "etc.)", "a/b", "", None, "é-\u4e2d\U0001f600x", "a\x00\x7fb"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    cleaned = [r[0] for r in df.select(text.normalise_category(F.col("v"))).collect()]
    assert cleaned == ["no longer leaking  wet less than 1 day", "etc  ", "a b", "", None, "    x", "a  b"]
    kinds = spark.createDataFrame([("My ENDO base",), ("Endorsement",), ("Declaration",), ("x",), (None,)], "t string")
    assert [r[0] for r in kinds.select(text.document_kind(F.col("t"))).collect()] == ["base", "endo", "dec", None, None]
    ids = spark.createDataFrame([("a_1_2",), ("a",), ("_x",)], "i string")
    assert [r[0] for r in ids.select(text.base_id(F.col("i"))).collect()] == ["a", None, ""]
    path = spark.createDataFrame([("flag/claims/2020-01-01 00:00:00.txt",)], "p string")
    got = path.select(text.path_part(F.col("p"), 2), text.file_stem(F.col("p")), text.path_part(F.col("p"), 9)).first()
    assert tuple(got) == ("claims", "2020-01-01 00:00:00", None)
    assert text.clean_columns(df.toDF("Amount (LCY)\r")).columns == ["Amount__LCY"]
    with pytest.raises(ValueError, match="collide"):
        text.clean_columns(spark.createDataFrame([(1, 2)], ["A B", "A(B"]))
    scores = spark.createDataFrame([([0.1, 0.98765],), ([1.0, 0.0],)], "p array<double>")
    assert [r[0] for r in scores.select(text.confidence(F.col("p"))).collect()] == ["98.77", "100.00"]


def test_one_hot(spark):
    claim = {
        "Status": "no longer leaking, wet <1 day",
        "Levels": "1 floor",
        "Rooms": "5 or more rooms",
        "Materials": "exterior contents (grill, patio furniture, etc.)",
        "Engagement": None,
        "source": "meteor",
    }
    df = spark.createDataFrame([tuple(claim.values())], schemas.TEXT_CLAIM)
    # the raw answer has one character per blank of the cleaned one, plus the final full stop and bracket
    hot = features.one_hot_fixed(features.normalise_columns(df, list(claim)), TEXT_VOCABULARY, sep=" ")
    assert len(hot.columns) == 44
    set_columns = [c for c, v in hot.first().asDict().items() if v]
    assert set_columns == [
        "Status no longer leaking  wet less than 1 day",
        "Levels 1 floor",
        "Rooms 5 or more rooms",
        "Materials exterior contents  grill  patio furniture  etc  ",
    ]
    coded = spark.createDataFrame([("HAIL", None, "LSOF", "RANA,RAOT", "MDFL,MDFL", "??")], schemas.CODED_CLAIM)
    hot = features.one_hot_fixed(features.fill_na(coded), CODE_VOCABULARY)
    assert len(hot.columns) == 40
    assert [c for c, v in hot.first().asDict().items() if v] == [
        "PerilTypeID_HAIL", "Status_NA", "Levels_LSOF", "Rooms affected_RANA,RAOT", "materials_MDFL,MDFL",
    ]
    learned = features.one_hot_learned(spark.createDataFrame([("b",), ("a",), (None,)], "v string"), ["v"])
    assert learned.columns == ["v_NA", "v_a", "v_b"]
    wide = spark.range(11_000).selectExpr("id", "cast(id as string) as v")
    long = features.one_hot_long(wide, ["v"], ["id"])
    assert long.count() == 11_000 and long.agg(F.max("position"), F.countDistinct("feature")).first()[:] == (10_999, 11_000)
    assert features.split_label(df) == (list(claim)[:-1], "source")
    vectors = features.one_hot_pipeline(["v"]).fit(spark.createDataFrame([("b",), ("a",)], "v string"))
    unseen = vectors.transform(spark.createDataFrame([("zzz",), ("a",)], "v string")).select("hot_v").collect()
    assert [list(r.hot_v.toArray()) for r in unseen] == [[0, 0], [1, 0]]


def test_delta_and_latest(spark):
    t = [datetime(2020, 1, d) for d in (1, 2, 3, 4)]
    df = spark.createDataFrame([(1, t[0], "a"), (1, t[1], "b"), (2, t[2], "c"), (2, t[2], "d"), (3, t[3], "e")], "k int, at timestamp, v string")
    assert rows(incremental.delta(df, "at", t[0], t[2]), "v") == [("b",), ("c",), ("d",)]
    assert rows(incremental.delta(df, "at", t[2]), "v") == [("e",)]
    assert rows(incremental.latest_per_key(df, ["k"], "at", ["v"]), "v") == [("b",), ("d",), ("e",)]
    assert incremental.latest_per_key(df, ["k"], "at").count() == 3


def test_counts(spark):
    a, b = spark.range(3), spark.range(2)
    got = incremental.reconcile(incremental.all_counts(spark, {"x": a, "y": b}), incremental.all_counts(spark, {"x": b, "z": a}))
    assert rows(got, "TableName", "source_rows", "loaded_rows", "diff") == [("x", 3, 2, 1), ("y", 2, 0, 2), ("z", 0, 3, -3)]
    assert incremental.all_counts(spark, {}).schema.simpleString() == "struct<TotalCount:int,TableName:string>"


def test_catalog():
    specs = catalog(["A", "B"], ["B"], {"A": ("id", "changed")}, {"B": "other"})
    assert [(s.name, s.mode, s.database) for s in specs] == [("A", DELTA, None), ("B", SNAPSHOT, "other")]
    with pytest.raises(ValueError, match="never loaded"):
        catalog(["A"], ["A", "C"], {})
    with pytest.raises(ValueError, match="change column"):
        catalog(["A"], [], {})


def test_jdbc_options():
    spec = TableSpec("Claim", DELTA, "ID", "changed", "claims.dbo")
    where = readers.delta_predicate(spec, "2020-01-01", "2020-02-01")
    options = readers.jdbc_options(spec, "jdbc:x", where, "ID", (0, 100), 4)
    assert options["dbtable"] == (
        "(select * from claims.dbo.Claim where changed > '2020-01-01' and changed <= '2020-02-01') source_rows"
    )
    assert (options["partitionColumn"], options["numPartitions"]) == ("ID", "4")
    assert readers.delta_predicate(spec, "2020-01-01") == "changed > '2020-01-01'"
    with pytest.raises(ValueError, match="column and its bounds"):
        readers.jdbc_options(spec, "jdbc:x", partitions=10)


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,B\n"one ""quoted""\nline",1\nx,\n')
    (tmp_path / "note.txt").write_text("not read")
    got = readers.read_csv_strings(spark, str(tmp_path / "*.csv"))
    assert rows(got, "A", "B") == [('one "quoted"\nline', "1"), ("x", None)]
    assert got.schema.simpleString() == "struct<A:string,B:string>"
    with pytest.raises(ValueError, match="no csv files"):
        readers.read_training(spark, str(tmp_path / "none"), "a int")


def test_training_files_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('payment_date,country_code\n2020-01-01,"U\nK"\n')
    (tmp_path / "b.csv").write_text("country_code,more,payment_date\nUS,1,2020-02-02\n")
    (tmp_path / "c.csv").write_text("country_code\n01\n")
    got = readers.read_training(spark, str(tmp_path), "payment_date string, country_code string, fee double")
    assert got.columns == ["payment_date", "country_code", "fee"]
    read = sorted(got.collect(), key=lambda r: r.country_code)
    assert list(map(tuple, read)) == [(None, "01", None), ("2020-01-01", "U\nK", None), ("2020-02-02", "US", None)]


def test_writers(spark, tmp_path):
    zone, hub, out = (str(tmp_path / n) for n in ("zone", "hub", "csv"))
    sinks.write_zone(spark.range(0, 100, 1, 1), zone, target_rows_per_file=30)
    sinks.write_zone(spark.range(0, 50, 1, 7), zone, balance=True)
    assert spark.read.parquet(zone).count() == 150
    assert len([f for f in (tmp_path / "zone").iterdir() if f.suffix == ".parquet"]) == 4 + 1
    df = spark.range(10).selectExpr("id", "if(id < 8, 'A', 'B') as c", "'x\"y' as t")
    sinks.replace_partition(df, hub, ["c"])
    sinks.replace_partition(df.filter("c = 'B'").limit(1), hub, ["c"])
    assert rows(spark.read.parquet(hub).groupBy("c").count(), "c", "count") == [("A", 8), ("B", 1)]
    sinks.export_csv_by(df, "c", out, rows_per_file=3)
    assert len(list((tmp_path / "csv" / "folder=A").glob("*.csv"))) == 3
    assert readers.read_csv_strings(spark, out).filter("t = 'x\"y'").count() == 10
    codes = spark.createDataFrame([("01", "a"), ("2", "b")], "code string, v string")
    sinks.export_csv_by(codes, "code", str(tmp_path / "codes"))
    assert rows(readers.read_csv_strings(spark, str(tmp_path / "codes")), "code", "v") == [("01", "a"), ("2", "b")]
    zones = [str(tmp_path / n) for n in ("one", "two")]
    for _ in range(2):
        sinks.fan_out(df, "b1", zones)
    assert [spark.read.parquet(z).count() for z in zones] == [10, 10]


def test_views(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert readers.view_frame(spark, "three").count() == 3
    assert readers.warehouse_query(spark, "select sum(id) as s from {t}", t=spark.range(4)).first().s == 6


def test_branch_lines(spark):
    """One sample per way a branch is decided."""
    want = {
        "WG2A": ("New South Wales", "CCS"), "47CAT": ("Queensland", "CCS"), "DW5E": ("South Australia", "CCS"), "33CAT": ("Tasmania", "CCS"),
        "ML3H": ("Victoria", "CCS"), "DW0A": ("Western Australia", "CCS"), "46MOT": ("Motor", "CCS"), "FFAT2": ("FRS", "GTS"),
        "CEO": ("Executive", "SS"), "CONEXP": ("Construction & Engineering", "GTS"), "TPA1": ("TPA", "TPA"), "DRONE": ("Contractor Connection", "Contractor Connection"),
        "0000": ("Head office", "SS"), "XSTRATAX": ("STRATA", "CCS"), "CFAS": ("GTS", "GTS"), "ZZ": ("Other", "ZZ"), "QL": ("Liability", "GTS"), "QF": ("Fusion", "CCS"),
    }
    got = classify.branch_lines(spark.createDataFrame([(b,) for b in want], "b string"), "b").collect()
    assert {r.b: (r.division, r.service_line) for r in got} == want


def test_one_clean_up(spark):
    """The pipeline's clean-up and the column expression give the same text."""
    values = ["no longer leaking, wet <1 day", "no longer leaking, wet >1 day", "a-b_c/d", "é\t1", "", None]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    staged = models.SQLTransformer(statement=models.clean_statement(["c"])).transform(df).select("clean_c").collect()
    plain = features.normalise_columns(features.fill_na(df), ["c"]).collect()
    assert [r[0] for r in staged] == [r[0] for r in plain]


def test_latest_file(spark):
    paths = ["o/UK/f-2020-01-02.csv", "o/UK/f-2020-01-10.csv", "o/UK/f-2021.tmp", "o//f.csv", "o/IT/f-1.csv"]
    got = incremental.latest_per_group(spark.createDataFrame([(p,) for p in paths], "path string"))
    assert rows(got, "folder", "path") == [("IT", "o/IT/f-1.csv"), ("UK", "o/UK/f-2020-01-10.csv")]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, path)
    for name in ("1", "2", "3"):
        versions.snapshot_replace(spark.range(int(name)), path, name, keep=2)
    assert versions.versions(spark, path) == ["2", "3"]
    half = tmp_path / "table" / "version=000000000099_x_4"
    half.mkdir()  # a writer that died: no commit marker
    assert versions.read_current(spark, path).count() == 3


def test_versions_are_ordered_by_their_writes(spark, tmp_path):
    path = str(tmp_path / "table")
    for name in ("8", "9", "10"):
        versions.snapshot_replace(spark.range(int(name)), path, name)
    assert versions.versions(spark, path) == ["9", "10"] and versions.read_current(spark, path).count() == 10
    before = versions.read_current(spark, path)
    versions.snapshot_replace(spark.range(3), path, "10")
    assert before.count() == 10 and versions.read_current(spark, path).count() == 3


def test_runs(spark, tmp_path):
    def put(path, content):
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(content)

    for run, value, lr in (("r1", 0.7, 1), ("r2", 0.5, 2), ("r3", 0.5, 3)):
        put(f"7/{run}/metrics/eval_rmse", f"1700000000000 9.0 0\n1700000001000 {value} 1\n")
        put(f"7/{run}/params/lr", str(lr))
        put(f"7/{run}/tags/mlflow.parentRunId", "p")
    put("7/p/metrics/eval_rmse", "1700000001000 0.1 0\n")
    put("7/meta.yaml", "x: 1")
    runs = readers.read_runs(spark, str(tmp_path))
    assert rows(metrics.best_run(runs, "eval_rmse"), "experiment", "parent", "run", "eval_rmse") == [("7", "p", "r2", 0.5)]
    assert rows(metrics.best_run(runs, "eval_rmse", "max"), "run") == [("r1",)]
    assert rows(metrics.pivot_runs(runs, ["lr"]).filter("lr is not null"), "run", "lr") == [("r1", "1"), ("r2", "2"), ("r3", "3")]
    assert runs.filter("kind = 'metrics' and run = 'r1'").count() == 2


def test_run_files(spark, tmp_path):
    files = [(f"7/r{k}/{kind}", value) for k in range(30) for kind, value in (("metrics/a b", f"1700000000000 {k}.5 0"), ("params/c+d%20é", "x y"), ("tags/none", None))]
    sources = spark.createDataFrame(files, "path string, value string").repartition(4)
    root = str(tmp_path / "runs")
    assert [sinks.write_files(sources, root) for _ in range(2)] == [90, 90]
    got = readers.read_runs(spark, f"file://{root}")
    assert rows(got.filter("run = 'r3'"), "experiment", "kind", "name", "value") == [("7", "metrics", "a b", "3.5"), ("7", "params", "c+d%20é", "x y")]
    assert got.count() == 60  # the empty files have no row
    assert sinks.write_files(sources.limit(0), root) == 0


def test_lookups(spark):
    dim = spark.createDataFrame([("b", "X", 2), ("a", "X", 1), ("c", None, 3)], "id string, name string, n int")
    df = spark.createDataFrame([("X",), (None,), ("Y",)], "name string")
    plain = lookups.lookup_first(df, dim, {"name": "name"}, {"found": "id"}, ["id"])
    assert rows(plain, "name", "found") == [("X", "a"), ("Y", None), (None, None)]
    safe = lookups.lookup_first(df, dim, {"name": "name"}, {"found": "id"}, ["id"], null_safe=True)
    assert rows(safe, "name", "found") == [("X", "a"), ("Y", None), (None, "c")]


def doc(**values):
    names = [f.split()[0] for f in schemas.DOCUMENT.split(", ")]
    return tuple(values.get(n) for n in names)


@pytest.fixture(scope="module")
def collections(spark):
    docs = [
        doc(ID="d1", DocumentType="Base Policy", CarrierName="C", DocumentPath="p1", FormNumber="F1", JsonData="{1}"),
        doc(ID="d2", DocumentType="Endorsement", CarrierName="C", DocumentPath="p2", FormNumber="F2", JsonData="{}"),
        doc(ID="d3", DocumentType="Declaration", CarrierName="Z", DocumentPath="p3", RetryCount=2),
        doc(ID="d4", DocumentType=None, JsonData="kept"),
        doc(ID="d1_1", DocumentType="part", DocumentPath="q1"),
        doc(ID="d1_0", DocumentType="part", DocumentPath="q0"),
        doc(ID="gone_0", DocumentType="part"),
    ]
    return {
        "docs": spark.createDataFrame(docs, schemas.DOCUMENT),
        "leases": spark.createDataFrame([doc(ID="l1", DocumentType=None, PolicyName="L")], schemas.DOCUMENT),
        "clients": spark.createDataFrame([("2", "C"), ("1", "C")], schemas.CLIENT),
        "prompts": spark.createDataFrame([("C", "P", "with policy"), ("C", None, "plain")], schemas.PROMPT),
        "policies": spark.createDataFrame(
            [("1", "C", "P", "d1", ["d2", "lost"]), ("2", "C", "Q", "d1", None), ("3", "C", "nobody", "d1", [])], schemas.POLICY
        ),
        "declarations": spark.createDataFrame(
            [
                ("1", "N1", "H1", "C", "P", "f", "s", "e", "v", ["d3"], ["d2", "missing", "d1"]),
                ("2", "N2", "H2", "C", "Q", "f", "s", "e", "v", ["d3", "d2"], None),
                ("3", "N3", "H3", "X", "X", "f", "s", "e", "v", None, []),
            ],
            schemas.DECLARATION,
        ),
    }


def test_migration(collections):
    out = documents.migrate_all(**collections, created="2024-01-01")
    got = {r.documentId: r for r in out["documents"].collect()}
    assert sorted(got) == ["d1", "d1_0", "d1_1", "d2", "d3", "gone_0", "l1"]
    assert (got["d1"].documentSubTag, got["d1"].clientID, got["d1"].prompt.qnAPrompId) == ("P", "1", "plain")
    assert (got["d2"].documentSubTag, got["d2"].jsonId, got["d2"].retryCount) == ("P", None, 0)
    assert (got["d3"].documentSubTag, got["d3"].uniqueId, got["d3"].retryCount) == ("P", "N2", 2)  # first name, last number
    assert got["d3"].metaData.holderName == "H2" and got["d1"].metaData is None
    # the later policy wins on d3: no applied endorsements, base form only
    assert got["d3"].childDocumentIds == [] and [f.formNumber for f in got["d3"].extractedFormNumbers] == ["F1"]
    assert [f.formNumber for f in got["d2"].extractedFormNumbers] == ["F1"]
    assert got["l1"].documentSubTag == "L" and got["l1"].metaData is None
    rejects = {(r.stage, r.id, r.reason) for r in out["rejects"].collect()}
    assert rejects == {
        ("Documents", "d4", "no document type"),
        ("Declaration", "3", "no declaration documents"),
        ("Child_documents", "missing", "applied endorsement not found"),
        ("Child_documents", "lost", "form number not found"),
        ("Child_documents", "2", "no applied endorsements"),
    }
    payloads = out["payloads"].collect()
    assert {p.JsonData for p in payloads} == {"{1}", "kept"} and got["d1"].jsonId in {p.jsonId for p in payloads}
    (merged,) = out["merged"].collect()
    assert merged.documentId == "d1" and merged.documentTag == "Merged Document" and merged.splitIndices == {}
    (nested,) = documents.nested_parts(out["merged"], out["parts"]).collect()
    assert [p.filePath for p in nested.splitDocumentList] == ["q0", "q1"]


def test_children_keep_order(collections):
    first = {k: v for k, v in collections.items() if k != "policies"}
    only = collections["policies"].filter("_id = '1'")
    got = {r.documentId: r for r in documents.migrate_all(policies=only, **first)["documents"].collect()}
    assert [c.documentId for c in got["d3"].childDocumentIds] == ["d2", "d1"]
    assert [f.formNumber for f in got["d3"].extractedFormNumbers] == ["F1", "F2"]


def test_use_policy_name(collections):
    names = ["docs", "clients", "policies", "declarations", "prompts"]
    target, _, _ = documents.migrate_documents(*[collections[n] for n in names], use_policy_name=True)
    assert target.filter("documentId = 'd1'").first().prompt.qnAPrompId == "with policy"


def test_scalar_ids(spark):
    dim = spark.createDataFrame([("d1", "N1"), (None, "N2")], "ids string, number string")
    assert rows(lookups.exploded_ids(dim, "ids"), "id", "number") == [("d1", "N1")]


def test_document_files(spark, collections):
    path = work_path(spark, "docs")
    sinks.write_documents(collections["declarations"], path)
    back = readers.read_documents(spark, path, schemas.DECLARATION)
    assert sorted(map(str, back.collect())) == sorted(map(str, collections["declarations"].collect()))


def test_metrics(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "label string, guess string")
    report = {r["class"]: r for r in metrics.class_report(df, "label", "guess").collect()}
    assert (report["b"].precision, report["b"].recall, report["b"].support) == (pytest.approx(1 / 3), 1.0, 1)
    assert (report["c"].precision, report["c"].recall, report["c"].f1) == (0.0, 0.0, 0.0)
    assert metrics.accuracy(df, "label", "guess").first().accuracy == 0.5
    matrix = metrics.confusion_matrix(df, "label", "guess", ["a", "b"])
    assert rows(matrix, "label", "predicted_a", "predicted_b", "predicted_other") == [("a", 1, 1, 0), ("b", 0, 1, 0), ("c", 0, 1, 0)]
    gaps = spark.createDataFrame([("a", "a"), ("a", None), ("a", "z")], "label string, guess string")
    assert metrics.accuracy(gaps, "label", "guess").first().accuracy == pytest.approx(1 / 3)
    assert rows(metrics.confusion_matrix(gaps, "label", "guess", ["a"]), "predicted_a", "predicted_other") == [(1, 2)]
    assert rows(metrics.class_report(gaps, "label", "guess"), "class", "support") == [("a", 3), ("z", 0)]
    some = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0), (1000.0, None)], "y double, p double")
    assert metrics.regression_metrics(some, "y", "p").first().r2 == pytest.approx(1 - 5 / 8)
    numbers = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "y double, p double")
    m = metrics.regression_metrics(numbers, "y", "p").first()
    assert (m.mae, m.mse, m.r2) == (1.0, pytest.approx(5 / 3), pytest.approx(1 - 5 / 8))
