import pytest
from helpers import FIVE, FIVE_SCHEMA, by, plan, rows
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import types as T

from ledgerlens.operators.loans import LOAN_SCHEMA, loan_features
from ledgerlens.session import scratch_path, scratch_root, written
from ledgerlens.sources import roles
from ledgerlens.sources.models import SavedModel, load_model, log_run, read_runs, save_model
from ledgerlens.sources.tables import explode_records, load, load_csv, save, save_csv, spread

RECORD = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())])


@pytest.mark.parametrize(
    "payload,want",
    [
        ('{"dataframe_records": [{"a": 1, "b": 2.5, "c": "x"}, {"c": "y"}]}', [(0, 1, 2.5, "x"), (1, None, None, "y")]),
        ('{"dataframe_split": {"columns": ["c", "a"], "data": [["x", 1], ["y", 2]]}}', [(0, 1, None, "x"), (1, 2, None, "y")]),
        ('{"dataframe_split": {"columns": ["b", "a"], "data": [[2.5]]}}', [(0, None, 2.5, None)]),
        ('{"dataframe_split": {"columns": ["a"], "data": [["not a number"]]}}', [(0, None, None, None)]),
        ('{"dataframe_records": []}', []),
        ("not json", None),
        (None, None),
    ],
)
def test_payloads(spark, payload, want):
    got = explode_records(spark.createDataFrame([(7, payload)], "id int, p string"), "p", RECORD, ["id"])
    # A payload that cannot be read is a row of its own.
    assert [tuple(r) for r in got.collect()] == ([(7, False, *[None] * 4)] if want is None else [(7, True, *w) for w in want])


def test_csv_round_trip_and_bad_values(spark, tmp_path):
    df = spark.createDataFrame(FIVE, FIVE_SCHEMA)
    path = str(tmp_path / "five")
    save_csv(df, path)
    save_csv(df, path)
    assert sorted(load_csv(spark, path, df.schema).collect()) == sorted(df.collect())
    file = tmp_path / "bad.csv"
    file.write_text("step,nameOrig\r\n1,a\r\noops,b\r\n")
    got = load_csv(spark, str(file), T.StructType([T.StructField("step", T.IntegerType()), T.StructField("nameOrig", T.StringType())]))
    assert [tuple(r) for r in got.collect()] == [(1, "a"), (None, "b")]


def test_loan_file_layout(spark, tmp_path):
    """First header empty, Windows line ends, whole numbers written as decimals."""
    file = tmp_path / "loans.csv"
    file.write_text(
        ",Gender,Married,Dependents,Education,Self_Employed,ApplicantIncome,CoapplicantIncome,LoanAmount,"
        "Loan_Amount_Term,Credit_History,Property_Area,Loan_Status\r\n"
        "1,0.0,1.0,1.0,1,0.0,4000,1500.0,128.0,360.0,1.0,0,0\r\n",
        newline="",
    )
    got = loan_features(load_csv(spark, str(file), LOAN_SCHEMA, enforceSchema="true")).first()
    assert got["loan_id"] == 1 and got["TotalIncome"] == 5500.0 and got["Loan_Status"] == 0
    assert got["EMI"] == pytest.approx(128 / 361) and got["Income_to_Loan_Ratio"] == pytest.approx(5500 / 129)
    assert got["Balance_Income"] == pytest.approx(5500 - 128 / 361 * 1000)


def test_save_replaces_rows_and_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    save(spark.range(5), path)
    save(spark.createDataFrame([("x",)], "name string"), path)
    assert rows(spark.read.parquet(path)) == [{"name": "x"}]


def test_load_from_catalog_and_folder(spark, smoke_dir):
    spark.range(3).createOrReplaceTempView("three")
    assert load(spark, "three").count() == 3
    assert load(spark, "nation", smoke_dir).count() == 25


def test_declared_schemas_are_those_of_the_files(spark, smoke_dir, small_dir):
    for directory in (smoke_dir, small_dir):
        for name in roles.SCHEMAS:
            assert roles.load(spark, name, directory).dtypes == load(spark, name, directory).dtypes


def test_scratch_is_under_the_configured_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert base is None or scratch_root(spark).startswith(base.rstrip("/"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    stored = written(spark.range(10), "ten")
    assert stored.count() == 10 and stored.inputFiles()


def test_spread_deals_rows_out(spark):
    one = spark.range(0, 100, 1, 1)
    assert spread(one, "id").count() == 100 and "hashpartitioning(id" in plan(spread(one, "id"))


def test_model_with_metadata(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="v")]).fit(df)
    rates = spark.createDataFrame([("A", 0.5)], "state string, fraud_rate double")
    saved = SavedModel(model, 0.3, ["a", "b"], {"auc": 0.9}, ["A", "B"], "test", rates)
    path = str(tmp_path / "m")
    save_model(spark, saved, path)
    save_model(spark, saved, path)
    got = load_model(spark, path)
    assert (got.threshold, got.features, got.metrics, got.states) == (0.3, ["a", "b"], {"auc": 0.9}, ["A", "B"])
    assert rows(got.rates) == [{"state": "A", "fraud_rate": 0.5}]
    assert got.model.transform(df).first()["v"].toArray().tolist() == [1.0, 2.0]


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    log_run(spark, path, "r1", {"trees": 100}, {"auc": 0.5})
    log_run(spark, path, "r2", metrics={"auc": 0.75})
    got = by(read_runs(spark, path).filter("run_id = 'r1'"), "name")
    assert got["trees"]["value"] == "100" and got["auc"]["kind"] == "metric"
    assert read_runs(spark, path).count() == 3
