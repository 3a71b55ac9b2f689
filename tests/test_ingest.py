import gzip
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import DEVICE_LOGS_SCHEMA, Config, IngestSpec, default_specs
from tidemark.session import scratch_path
from tidemark.sources import landing, tables
from tidemark.streaming import ingest
from tidemark.streaming.schemas import load_or_create_schema, load_schema

HEADER = ("transaction_id,card_id,customer_id,merchant_id,txn_timestamp,amount,currency,mcc_code,channel,txn_type,"
          "status,country,is_fraud_flag,txn_date")


def txn(i):
    return f"t{i},k{i},c{i},m1,2026-07-01 00:00:00,{i}.50,USD,5411,POS,purchase,approved,US,false,2026-07-01"


def put(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("".join(line + "\n" for line in lines))


@pytest.fixture
def cfg(tmp_path):
    return Config("dev", str(tmp_path / "landing"), str(tmp_path / "lake"))


def spec_of(cfg, name):
    return next(s for s in cfg.specs if s.name == name)


def raw(spark, cfg, name):
    return ingest.bronze(spark, spec_of(cfg, name), cfg)


def test_csv_files_are_loaded_once(spark, cfg):
    spec = spec_of(cfg, "transactions")
    put(f"{spec.source}/2026/07/a.csv", HEADER, txn(1), txn(2))
    ingest.ingest(spark, spec, cfg, "run-1")
    ingest.ingest(spark, spec, cfg, "run-2")
    assert raw(spark, cfg, "transactions").count() == 2
    put(f"{spec.source}/2026/08/b.csv", HEADER, txn(3))
    ingest.ingest(spark, spec, cfg, "run-3")
    got = {r.transaction_id: r for r in raw(spark, cfg, "transactions").collect()}
    assert {k: v._pipeline_run_id for k, v in got.items()} == {"t1": "run-1", "t2": "run-1", "t3": "run-3"}
    assert got["t1"]._partition_date == "2026-07" and got["t3"]._partition_date == "2026-08"
    assert got["t1"].amount == "1.50" and got["t1"]._rescued_data is None
    assert got["t3"]._source_file.endswith("/2026/08/b.csv") and got["t3"]._ingested_at is not None


def test_csv_columns_bind_by_name_and_rest_is_rescued(spark, cfg):
    spec = spec_of(cfg, "merchants")
    put(f"{spec.source}/plain.csv", "merchant_id,merchant_name,mcc_code,category,country,onboarding_date,merchant_risk_score",
        "m1,Shop,5411,food,US,2020-01-01,1.5")
    put(f"{spec.source}/reordered and [odd] name.csv", "country,Merchant_ID,merchant_name", 'DE,m2,"Caf, Bar"')
    put(f"{spec.source}/extra.csv", "merchant_id,vip,merchant_name", "m3,yes,Inn", "m4,,Pub")
    put(f"{spec.source}/ragged.csv", "merchant_id,merchant_name", "m5,Two,unexpected")
    put(f"{spec.source}/empty.csv")
    ingest.ingest(spark, spec, cfg, "r")
    got = {r.merchant_id: r for r in raw(spark, cfg, "merchants").collect()}
    assert set(got) == {"m1", "m2", "m3", "m4", "m5"}
    assert (got["m2"].country, got["m2"].merchant_name, got["m2"].mcc_code) == ("DE", "Caf, Bar", None)
    assert json.loads(got["m3"]._rescued_data) == {"vip": "yes"} and got["m4"]._rescued_data is None
    assert json.loads(got["m5"]._rescued_data) == {"_corrupt_record": "m5,Two,unexpected"}
    assert got["m1"]._rescued_data is None and got["m1"].merchant_risk_score == "1.5"


def test_csv_batches_are_bounded_and_complete(spark, tmp_path):
    cfg = Config("dev", str(tmp_path / "landing"), str(tmp_path / "lake"), max_files_per_batch=2)
    spec = spec_of(cfg, "transactions")
    for i in range(5):
        put(f"{spec.source}/txn_year=2026/txn_month=0{i + 1}/p.csv", HEADER, txn(i))
    ingest.ingest(spark, spec, cfg, "r")
    df = raw(spark, cfg, "transactions")
    assert df.count() == 5 and df.select("_batch_id").distinct().count() == 3
    assert sorted(r._partition_date for r in df.collect()) == [f"2026-0{i}" for i in range(1, 6)]


SESSION = {"session_id": "s1", "customer_id": "c1", "device_id": "d1", "event_type": "login",
           "event_timestamp": "2026-07-01T10:00:00", "ip_address": "1.2.3.4",
           "geo": {"lat": 1.5, "long": 2.5, "city": "X"}, "device_meta": {"os": "iOS", "device_model": "m"}}


def test_json_rescue(spark, cfg):
    spec = spec_of(cfg, "device_session_logs")
    put(f"{spec.source}/2026/07/a.json",
        json.dumps(SESSION),
        json.dumps({**SESSION, "session_id": "s2", "carrier": "T", "geo": {"lat": "north", "long": 1, "alt": 7}}),
        json.dumps({**SESSION, "session_id": "s3", "geo": "nowhere"}),
        "", "{broken",
        json.dumps({"session_id": "s4", "geo": None}))
    ingest.ingest(spark, spec, cfg, "r1")
    ingest.ingest(spark, spec, cfg, "r2")
    rows = raw(spark, cfg, "device_session_logs").collect()
    assert len(rows) == 5
    got = {r.session_id: r for r in rows}
    assert got["s1"]._rescued_data is None and got["s1"].geo.lat == 1.5 and got["s1"].geo.accuracy_m is None
    lost = json.loads(got["s2"]._rescued_data)
    assert lost == {"$": {"carrier": "T"}, "geo": {"lat": "north", "alt": "7"}}
    assert got["s2"].geo.long == 1.0 and got["s2"].geo.lat is None
    assert json.loads(got["s3"]._rescued_data) == {"$": {"geo": "nowhere"}} and got["s3"].customer_id == "c1"
    assert json.loads(got[None]._rescued_data) == {"_corrupt_record": "{broken"}
    assert got["s4"]._rescued_data is None


def files_read(df):
    """Files that the scan of a plan without shuffles has opened."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numFiles").value()


def test_sessions_lie_by_the_day_of_their_event(spark, cfg):
    """Rows of several days in one drop, late ones and one without a time: a day is one directory, raw and typed."""
    from tidemark.streaming.refine import read_silver, refine
    spec = spec_of(cfg, "device_session_logs")

    def session(i, day):
        return json.dumps({**SESSION, "session_id": f"s{i}", "event_timestamp": f"{day}T10:00:00"})
    put(f"{spec.source}/2026/07/a.json", *[session(i, f"2026-07-0{1 + i % 3}") for i in range(9)], "{broken")
    ingest.ingest(spark, spec, cfg, "r1")
    put(f"{spec.source}/2026/07/b.json", session(9, "2026-07-01"), session(10, "2026-07-09"))
    ingest.ingest(spark, spec, cfg, "r2")
    refine(spark, spec, cfg)
    for table, directories in ((raw(spark, cfg, "device_session_logs"), 2), (read_silver(spark, cfg, "device_session_logs"), 1)):
        day = table.where("_event_date = DATE'2026-07-01'").select("session_id", "event_timestamp")
        assert sorted(r.session_id for r in day.collect()) == ["s0", "s3", "s6", "s9"]
        whole = files_read(table.select("session_id"))
        assert files_read(day) <= directories < whole
    assert raw(spark, cfg, "device_session_logs").where("_event_date IS NULL").count() == 1


def test_all_datasets_in_order_and_one_failure_does_not_stop_the_rest(spark, cfg):
    put(f"{cfg.landing_root}/customers/full_load/a.csv", "customer_id,full_name", "c1,Ann")
    put(f"{cfg.landing_root}/transactions/2026/07/a.csv", HEADER, txn(1))
    put(f"{cfg.landing_root}/device_session_logs/2026/07/a.json", json.dumps(SESSION))
    with pytest.raises(ingest.IngestError, match="completed with failures: merchants"):
        ingest.ingest_all(spark, cfg, "r")
    assert raw(spark, cfg, "customers").count() == raw(spark, cfg, "device_session_logs").count() == 1
    put(f"{cfg.landing_root}/merchants/full_load/a.csv", "merchant_id", "m1")
    status = ingest.ingest_all(spark, cfg).collect()
    assert [r.dataset for r in status] == ["customers", "merchants", "transactions", "device_session_logs"]
    assert {r.status for r in status} == {"OK"}
    assert raw(spark, cfg, "customers").count() == 1
    assert raw(spark, cfg, "merchants").first()._pipeline_run_id.startswith("local-")


def test_schema_is_settled_once(spark, tmp_path):
    src = str(tmp_path / "in")
    put(f"{src}/a.json", json.dumps({"a": 1, "b": {"c": "x"}}))
    spec = IngestSpec("free", "json", src, "t")
    first = load_or_create_schema(spark, spec, str(tmp_path / "schema"))
    put(f"{src}/b.json", json.dumps({"a": 1, "z": 2}))
    assert load_or_create_schema(spark, spec, str(tmp_path / "schema")) == first
    assert first.fieldNames() == ["a", "b"]
    assert load_schema(spark, str(tmp_path / "none")) is None


def test_environment_is_checked():
    with pytest.raises(ValueError):
        Config("test", "a", "b")
    assert [s.name for s in default_specs("x")] == ["customers", "merchants", "transactions", "device_session_logs"]
    cfg = Config("prod", "land", "lake")
    assert cfg.checkpoint_path(cfg.specs[0]) == "lake/checkpoints/customers"


def test_audit_columns_on_files(spark, tmp_path):
    put(f"{tmp_path}/x/a.csv", "v", "1", "2")
    df = ingest.add_audit_cols(landing.read_landing_csv(spark, f"{tmp_path}/x"), "run-9")
    row = df.first()
    assert row._pipeline_run_id == "run-9" and row._source_file.endswith("a.csv") and row._ingested_at is not None
    assert dict(df.dtypes)["_ingested_at"] == "timestamp"


def test_landing_readers_and_writers(spark, tmp_path):
    df = spark.range(10).select(
        F.col("id").cast("string").alias("id"),
        (F.lit("2026-01-30 10:00:00").cast("timestamp") + F.make_interval(days=F.col("id").cast("int"))).alias("ts"))
    landing.write_partitioned_csv(df, "ts", f"{tmp_path}/csv")
    assert sorted(d for d in os.listdir(f"{tmp_path}/csv/txn_year=2026") if "=" in d) == ["txn_month=01", "txn_month=02"]
    back = landing.read_landing_csv(spark, f"{tmp_path}/csv")
    assert back.count() == 10 and "txn_year" not in back.columns and set(dict(back.dtypes).values()) == {"string"}
    landing.write_daily_json(df, "ts", f"{tmp_path}/json")
    assert landing.read_landing_json(spark, f"{tmp_path}/json/*/*/*").count() == 10
    assert len([1 for _, dirs, _ in os.walk(f"{tmp_path}/json") for d in dirs if d.startswith("day=")]) == 10
    landing.write_csv(df, f"{tmp_path}/dim")
    assert len([f for f in os.listdir(f"{tmp_path}/dim") if f.endswith(".csv")]) == 1
    with pytest.raises(Exception):
        landing.read_landing_csv(spark, f"{tmp_path}/dim", df.select("ts", "id").schema).collect()
    assert landing.inline_df(spark, [(1, "a")], "x int, y string").first().y == "a"


def test_managed_table_is_replaced(spark):
    name = f"db_{os.getpid()}.t"
    tables.write_table(spark.range(5), name)
    tables.write_table(spark.range(3), name)
    assert tables.read_table(spark, name).count() == 3
    spark.sql(f"DROP DATABASE {name.split('.')[0]} CASCADE")


def test_scratch_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    assert path.startswith(configured) if configured else os.path.isdir(os.path.dirname(path))


def test_headers_take_no_job(spark, tmp_path):
    from tidemark.streaming.rescue import csv_headers
    paths = []
    for i in range(12):
        put(str(tmp_path / f"in/f {i}.csv"), "" if i == 3 else "a,b,B" if i % 2 else "\ufeffx,,y", "1,2,3", "4,5,6")
        paths.append(str(tmp_path / f"in/f {i}.csv"))
    put(str(tmp_path / "in/nothing.csv"))
    with gzip.open(tmp_path / "in/packed.csv.gz", "wt") as f:
        f.write("g,h\n1,2\n")
    odd = [f"file:{tmp_path}/in/f 5.csv", str(tmp_path / "in/nothing.csv"), str(tmp_path / "in/packed.csv.gz")]
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        got = csv_headers(spark, paths + odd)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert jobs == 0
    assert got[paths[0]] == ("x", "_c1", "y") and got[paths[1]] == ("a", "b1", "B2") and got[paths[3]] == ("1", "2", "3")
    assert [got[p] for p in odd] == [("a", "b1", "B2"), (), ("g", "h")]


def test_a_batch_reads_its_files_once(spark, cfg):
    """Bytes that the file system hands out while a batch is ingested: about those of its files, headers included."""
    spec = spec_of(cfg, "customers")
    for i in range(4):
        order = ["customer_id", "full_name", "address"][::(-1) ** i]
        put(f"{spec.source}/full_load/{i}.csv", ",".join(order), *[f"{n},{'x' * 150},{'y' * 150}" for n in range(15_000)])
    size = sum(os.path.getsize(f"{spec.source}/full_load/{i}.csv") for i in range(4))

    def handed_out():
        return sum(s.getBytesRead() for s in spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = handed_out()
    ingest.ingest(spark, spec, cfg, "r")
    assert size > 15_000_000 and handed_out() - before < 1.1 * size
    assert raw(spark, cfg, "customers").count() == 60_000


def test_a_failure_without_message_stops_nobody(spark, tmp_path, monkeypatch):
    from tidemark.config import Config
    from tidemark.streaming import ingest as module
    seen = []

    def broken(spark, spec, cfg, run_id):
        seen.append(spec.name)
        raise RuntimeError() if len(seen) == 1 else ValueError("first line\nsecond line")
    monkeypatch.setattr(module, "ingest", broken)
    cfg = Config("dev", str(tmp_path / "landing"), str(tmp_path / "lake"))
    got = module.ingest_all(spark, cfg, "r", strict=False).collect()
    assert len(seen) == len(cfg.specs) == len(got)
    assert got[0].error == "RuntimeError" and got[1].error == "first line\nsecond line"
    with pytest.raises(module.IngestError, match="second line") as caught:
        module.ingest_all(spark, cfg, "r")
    assert isinstance(caught.value.__cause__, ExceptionGroup)


LINES = [
    SESSION, {}, {"geo": {}}, {"geo": None}, {"geo": {"lat": None}}, {"geo": []}, {"geo": ""}, {"geo": {"lat": "1.5"}},
    {**SESSION, "geo": {"lat": 1, "city": "X", "alt": 7}}, {**SESSION, "geo": {"lat": "north", "long": 2}},
    {**SESSION, "device_meta": {"os": 5}}, {**SESSION, "carrier": None}, {**SESSION, "carrier": {"name": "T"}},
    {**SESSION, "Session_id": "other"}, {**SESSION, "device_meta": "none", "geo": {"alt": 1, "lat": 2.5}}, [SESSION], 5, "text", None,
]
TEXTS = ["{broken", '{"session_id": "a"} b', '{"session_id": "a", "session_id": "b"}', '{"geo": {"lat": 1, "lat": 2}}',
         "{'session_id': 'a'}", '{"geo": {"lat": NaN}}']


def taken_apart(lines, schema):
    """Rescue that takes every line apart, as a reference."""
    from tidemark.streaming import rescue
    text, strings = F.col("value"), T.MapType(T.StringType(), T.StringType())
    rows = lines.withColumns({"_typed": F.from_json(text, schema), "_raw": F.from_json(text, strings),
                              "_valid": F.try_parse_json(text).isNotNull()})
    losses = [rescue._lost_entries(F.col("_raw"), F.col("_typed"), schema.fields).alias("$")]
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            losses.append(rescue._lost_entries(F.from_json(F.element_at("_raw", f.name), strings), F.col("_typed")[f.name], f.dataType.fields).alias(f.name))
    packed = F.to_json(F.struct(*losses))
    return rows.select("value", "_typed.*", F.when(~F.col("_valid") | F.col("_raw").isNull(), F.to_json(F.struct(text.alias("_corrupt_record"))))
                       .when(packed != "{}", packed).alias("_rescued_data"))


def test_only_lossy_lines_are_taken_apart(spark):
    from tidemark.streaming.rescue import parse_json_rescued
    quoted = T.StructType([T.StructField("session_id", T.StringType()),
                           T.StructField("it's", T.StructType([T.StructField("a", T.StringType())]))])
    texts = [json.dumps(x) for x in LINES] + TEXTS + ['{"it\'s": {"a": "1"}}', '{"it\'s": {"a": "1", "b": "2"}}']
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    for schema in (DEVICE_LOGS_SCHEMA, quoted):
        got = parse_json_rescued(lines.withColumn("line", F.col("value")), schema)
        want = taken_apart(lines, schema)
        assert sorted(map(repr, got.select("line", *[c for c in want.columns if c != "value"]).collect())) == sorted(
            repr(r).replace("Row(value=", "Row(line=") for r in want.collect())
    # Maps of strings are read in a branch of the last projection, not for every line.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and not [l for l in plan.splitlines() if "MapType" in l and "CASE WHEN" not in l]


def test_the_month_is_worked_out_per_file(spark):
    names = [f"file:/l/txn_year=2026/txn_month=0{i}/a b%20é.csv" for i in (1, 2)] + ["file:/l/2026/07/a.csv", "file:/l/none.csv"]
    rows = spark.createDataFrame([(p,) for p in names * 2], "_source_file string")
    for known in (names, names[:1], ["file:/l/other.csv"]):  # a file that is not in the list has its own path looked at
        got = ingest._with_month(rows, known)
        assert sorted({tuple(r) for r in got.collect()}) == sorted(zip(names, ["2026-01", "2026-02", "2026-07", None])) and got.count() == 8
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_every_transaction_lands_once(spark, tmp_path):
    """Repeated and missing ids, and times that do not parse, neither repeat nor lose a row."""
    from tidemark import registry
    spark.sql("""SELECT * FROM VALUES (1L), (1L), (1L), (109L), (CAST(NULL AS BIGINT)) AS t(o_orderkey)""").selectExpr(
        "o_orderkey", "7L AS o_custkey", "'P' AS o_orderstatus", "10.5D AS o_totalprice", "timestamp_ntz'1996-02-03 00:00:00' AS o_orderdate",
        "'5-LOW' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    got = registry.ingest_transactions(spark, str(tmp_path)).collect()
    assert sorted(str(r.transaction_id) for r in got) == ["1", "1", "1", "109", "None"]
    assert {r._partition_date for r in got} == {"1996-02"}
