import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from veilframe.functions import crypto
from veilframe.operators import classify, contracts, messages, policies, protect, reports, signing, traffic, verdicts, warehouse
from veilframe.sources import tables

KEYS = crypto.Keys("v1", bytes(range(32)), bytes(range(40)))
PANS = ["4111111111111111", "5555555555554444", "378282246310005", "6011111111111117"]


@pytest.fixture(scope="module")
def sales(spark):
    rows = [(str(i), f"user{i}@example.com", f"{i}.5", PANS[i % 4], f"2026-01-0{i + 1} 10:00:00") for i in range(6)]
    return spark.createDataFrame(rows, "id string, customer_email string, sale_price string, card_info string, sold_at string")


def test_inference(sales):
    m = classify.infer(sales, "sales")
    facts = {c.name: (c.sql_type, c.sensitivity, c.treatment) for c in m.columns}
    assert facts == {
        "id": ("BIGINT", "public", ""), "customer_email": ("TEXT", "direct_identifier", ""), "sale_price": ("DOUBLE PRECISION", "public", ""),
        "card_info": ("BIGINT", "direct_identifier", "card_split"), "sold_at": ("TIMESTAMP", "public", ""),
    }
    assert (m.primary_key, m.key_is_synthetic, m.row_count, m.indexed) == ("id", False, 6, ["customer_email"])


def test_values_of_opaque_columns(spark):
    df = spark.createDataFrame([(f"a{i}@x.org", f"{i}234.567891", "19999999999999999999") for i in range(4)], "f_3 string, area string, big string")
    m = classify.infer(df, "d")
    assert [(c.sensitivity, c.sql_type) for c in m.columns] == [("direct_identifier", "TEXT"), ("public", "DOUBLE PRECISION"), ("direct_identifier", "TEXT")]  # twenty digits are no bigint, and read like a phone number


def test_synthetic_key_overrides_and_missing_values(spark, tmp_path):
    df = spark.createDataFrame([("a", "1", None), ("a", "1", ""), ("a", "2", "x")], "status string, year string, county string")
    m = classify.infer(df, "d", {"columns": {"county": {"sensitivity": "public"}}})
    assert m.key_is_synthetic and m.primary_key == "row_hash" and m.overrides_applied == ["county"]
    assert [c.nullable for c in m.columns] == [False, False, True]
    m.save(tmp_path / ".m.json")
    assert classify.Manifest.load(tmp_path / ".m.json") == m
    with pytest.raises(ValueError):
        classify.infer(df, "d", {"primary_key": "nope"})
    empty = classify.infer(df.where("false"), "d")
    assert {c.sql_type for c in empty.columns} == {"TEXT"} and empty.row_count == 0


def test_contract(spark, sales, tmp_path):
    m, path = classify.infer(sales, "sales"), tmp_path / "sales.json"
    assert contracts.ensure(spark, m, path) == "created"
    assert contracts.ensure(spark, m, path) == "matched"
    drifted = classify.infer(sales.drop("sold_at").withColumn("phone", F.lit("1")), "sales")
    with pytest.raises(contracts.ContractMismatch, match="missing from the data") as e:
        contracts.ensure(spark, drifted, path)
    assert "'phone': in the data" in str(e.value) and not e.value.retryable
    contracts.accept(drifted, path)
    assert contracts.ensure(spark, drifted, path) == "matched"


def test_policies(sales, tmp_path):
    m, path = classify.infer(sales, "sales"), tmp_path / "policy.json"
    assert sorted(policies.generate(m, "db", path)) == ["card_info", "customer_email"]
    before = path.read_text()
    assert policies.generate(m, "db", path) == [] and path.read_text() == before
    local = policies.LocalPolicies(path)
    assert local.masks("db", "sales", policies.ANALYSTS) == {"card_info": "MASK_HASH", "customer_email": "MASK_HASH"}
    assert set(local.masks("db", "sales", policies.STEWARDS).values()) == {"MASK_NONE"}
    assert local.masks("db", "other", policies.ANALYSTS) == {}


def test_protection_stages(spark, sales, tmp_path):
    m = classify.infer(sales, "sales")
    protect.encrypt_batch(sales, m, crypto.Encryptor(KEYS), "2026-01-01").write.parquet(str(tmp_path / "e"))
    e = spark.read.parquet(str(tmp_path / "e"))
    assert e.columns == ["id", "logical_date", "sale_price", "sold_at", "card_info_encrypted", "customer_email_encrypted", "customer_email_blind_index"]
    assert protect.encryption_leaks(e, sales, "id", ["card_info", "customer_email"]).count() == 0
    leaky = e.withColumn("customer_email_encrypted", F.when(F.col("id") == "1", "user1@example.com").otherwise(F.col("customer_email_encrypted"))).withColumn("card_info", F.lit("x"))
    with pytest.raises(protect.LeakError):
        protect.refuse_if_any(protect.encryption_leaks(leaky, sales, "id", ["card_info", "customer_email"]), "test")
    masked = protect.mask_batch(e, m, crypto.Decryptor(KEYS), {"card_info": "MASK_SHOW_LAST_4", "customer_email": "MASK_HASH"}, "local")
    row = masked.where("id = '0'").first()
    assert row.card_info_masked == "*" * 12 + "1111" and masked.columns[:3] == ["id", "logical_date", "masked_by"]
    with pytest.raises(policies.MissingPolicy):
        protect.mask_batch(e, m, crypto.Decryptor(KEYS), {"card_info": "MASK_HASH"}, "local")
    table = protect.card_table(sales, m, crypto.Encryptor(KEYS), "2026-01-01")
    assert table.count() == 6 and protect.card_leaks(table).count() == 0
    assert protect.flat_leaks(["id", "a_masked", "customer_email"], ["customer_email"]) == ["a_masked", "customer_email"]


def test_mask_that_changes_nothing_is_refused(spark, tmp_path):
    df = spark.createDataFrame([("1", "ab"), ("2", "cd"), ("3", "ef")], "id string, name string")
    m = classify.infer(df, "d")
    protect.encrypt_batch(df, m, crypto.Encryptor(KEYS), "2026-01-01").write.parquet(str(tmp_path / "e"))
    with pytest.raises(Exception, match="leaves a value"):
        protect.mask_batch(spark.read.parquet(str(tmp_path / "e")), m, crypto.Decryptor(KEYS), {"name": "MASK_SHOW_FIRST_4"}, "local").collect()


def test_sensitive_key_is_never_in_the_card_table(spark):
    df = spark.createDataFrame([(f"u{i}@x.org", PANS[i % 4]) for i in range(4)] + [("u9@x.org", "1234")], "email string, card_info string")
    m = classify.infer(df, "d", {"primary_key": "email"})
    rows = protect.card_table(df, m, crypto.Encryptor(KEYS), "2026-01-01").collect()
    assert all("@" not in r.row_key for r in rows)
    assert [r.card_prefix for r in rows if r.card_suffix == ""] == [""]


def test_upsert_and_versions(spark, tmp_path):
    t = warehouse.VersionedTable(spark, str(tmp_path / "t"))
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (2, "c", 2)], "k int, v string, o int")
    assert t.upsert(new, ["k"], [F.col("o")]) == {"inserted": 2, "updated": 0}
    more = spark.createDataFrame([(2, "d", 3, True), (3, "e", 1, False)], "k int, v string, o int, extra boolean")
    assert t.upsert(more, ["k"], [F.col("o")]) == {"inserted": 1, "updated": 1}
    assert {(r.k, r.v, r.extra) for r in t.read().collect()} == {(1, "a", None), (2, "d", True), (3, "e", False)}
    assert t.version() == 2


def test_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "p")
    for slot, values in (("s1", [1, 2]), ("s2", [3]), ("s1", [9])):
        warehouse.write_partitions(spark.createDataFrame([(v, slot) for v in values], "v int, run_slot string"), path, "run_slot")
    assert {(r.v, r.run_slot) for r in spark.read.parquet(path).collect()} == {(9, "s1"), (3, "s2")}
    with pytest.raises(ValueError):
        warehouse.Scope("1=1 or run_slot", "x")


def test_registration_is_optional(spark, tmp_path):
    df = spark.range(3).withColumn("run_slot", F.lit("s1"))
    warehouse.write_partitions(df, str(tmp_path / "r"), "run_slot")
    spark.sql("DROP TABLE IF EXISTS registered_rows")
    assert warehouse.register(spark, df, "registered_rows", str(tmp_path / "r"), "run_slot")["registered"]
    assert warehouse.table_count(spark, "registered_rows") == 3 and warehouse.table_count(spark, "no_such_table") is None
    assert not warehouse.register(spark, df, "bad name!", str(tmp_path / "r"))["registered"]


def test_report(spark):
    df = spark.createDataFrame([(i, float(i), "abc"[i % 3], datetime(2026, 1, 1, i % 5)) for i in range(30)], "id int, amount double, kind string, at timestamp")
    r = reports.build(df.withColumn("masked_by", F.lit("x")), "id")
    assert [c.kind for c, _ in r["charts"]] == ["by_hour", "histogram", "categories"]
    assert r["tiles"][0] == ("30", "RECORDS") and r["tiles"][3] == ("435", "TOTAL AMOUNT")
    hist = dict(r["charts"][1][1])
    assert hist[7] == 1 and sum(hist.values()) == 30
    assert "Records by kind" in reports.to_markdown(r, "t", {"start": "a", "end": "b", "source": "logical_date"})
    assert reports.build(df.where("false").drop("at", "kind"), "id")["charts"] == []


def event_set(**changes):
    events = {
        "extract": {"rows": 3, "window_source": "logical_date"}, "card_split": {"cards": 0}, "encrypt": {"engine": "spark", "spark_configured": True}, "publish": {"rows": 3, "topic_public": "f"},
        "mask": {}, "hive_register": {"registered": True, "table": "t"}, "load": {"inserted": 2, "updated": 1, "dataset": "d"}, "report": {"collected": "/x.pdf"},
    }
    return {k: v for k, v in (events | changes).items() if v is not None}


def test_verdict():
    v = verdicts.compute(event_set(), now=datetime(2026, 1, 1, tzinfo=UTC))
    assert (v["proceed"], v["status"], v["reasons"], v["outputs"]["rows_loaded"]) == (True, "complete", [], 3)
    for stage in verdicts.STAGES:
        v = verdicts.compute(event_set(**{stage: None}))
        assert v["proceed"] == (stage == "hive_register") and v["status"] == ("degraded" if stage == "hive_register" else "failed")
    v = verdicts.compute(event_set(load=None), {"load": "boom\n  again", "mask": "ignored"})
    assert v["reasons"] == ["load failed: boom again"]
    v = verdicts.compute(event_set(hive_register={"registered": False}, report={"collected": "disk full"}))
    assert v["reasons"] == ["hive table not registered: no reason given", "delivery copy failed: disk full"]


def test_messages(spark):
    env = lambda kind: messages.envelope(kind, "d", F.lit("2026-01-01T04:00:00").cast("timestamp"), F.lit("t"), "r", 1, F.col("id"), "p", F.current_timestamp())
    df = spark.createDataFrame([("1", "enc:v1:AAAA", "ix", None)], "id string, n_encrypted string, n_blind_index string, price string")
    out = messages.row_messages(df, env, df.columns, ["n"]).withColumn("m", messages.decode(F.col("value")))
    assert [r[0] for r in out.select(messages.problems(F.col("m"))).collect()] == [[], []]
    flat = json.loads(out.where("topic = 'rows.flat'").first().value)
    assert flat["payload"] == {"id": "1", "price": None} and flat["envelope"]["run_slot"] == "2026-01-01T04:00:00Z"
    with pytest.raises(protect.LeakError):
        messages.row_messages(df.withColumn("n", F.lit("x")), env, [*df.columns, "n"], ["n"])
    bad = spark.createDataFrame([("{",), ("[]",), ('{"envelope": {}}',), ('{"envelope": {}, "payload": {}}',)], "v string")
    assert [len(r[0]) > 0 for r in bad.select(messages.problems(messages.decode(F.col("v")))).collect()] == [True] * 4


def test_schema_compatibility():
    old = {"required": ["a"], "properties": {"a": {"type": "string", "enum": ["x", "y"]}, "b": {"type": ["string", "null"]}}}
    assert messages.incompatible(old, old) == []
    new = {"required": [], "properties": {"a": {"type": "string", "enum": ["x"]}, "b": {"type": "string"}}}
    assert messages.incompatible(old, new) == ["/a: no longer required", "/a: enum values removed", "/b: type ['string', 'null'] became string"]


def test_signatures(spark):
    private, public = signing.JvmSigner.generate_keys(spark)
    message = {"envelope": {"event_id": "e"}, "payload": {"proceed": True, "é": 1}}
    token = signing.JvmSigner(spark, "i", "a", "s", private).sign("e", message["payload"])
    assert signing.verify(spark, token, public, message, "i", "a", "s")["event_id"] == "e"
    head, body, mark = token.split(".")
    none = signing._b64(b'{"alg":"none"}')
    _, other = signing.JvmSigner.generate_keys(spark)
    for t, m, key, issuer in (
        (f"{none}.{body}.", message, public, "i"), (token, message | {"payload": {"proceed": False}}, public, "i"), (token, message, other, "i"), (token, message, public, "j"), ("x", message, public, "i"), (None, message, public, "i"),
    ):
        with pytest.raises(signing.SignatureError):
            signing.verify(spark, t, key, m, issuer, "a", "s")


def test_sources(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes('\ufeffid,"no""te"\n1,"two\nlines ""x"" \\"\n2,\n'.encode())
    rows = tables.read_csv(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("1", 'two\nlines "x" \\'), ("2", None)]
    with pytest.raises(tables.SourceError):
        tables.SqlSource("select 1")
    spark.range(1000).createOrReplaceTempView("numbers_source")
    with pytest.raises(tables.SourceError, match="cap"):
        tables.SqlSource("select * from numbers_source limit :row_limit", max_bytes=1).frame(spark, datetime(2026, 1, 1), datetime(2026, 1, 2))
    got = tables.with_fallback(lambda: spark.range(0), lambda: spark.range(2), 2)
    assert (got.fell_back, got.attempts, got.frame.count()) == (True, 2, 2)
    orders = tables.synthetic_orders(spark, 50)
    assert orders.where(F.length("card_info") == 16).where("luhn_check(card_info)").count() == 50


def test_changes_in_slots(spark):
    rows = [(d, t, v) for d in ("a", None) for t, v in ((1, True), (2, True), (5, None), (6, False), (21, False), (22, True), (40, True), (41, None))]
    df = spark.createDataFrame(rows, "dataset string, at long, healthy boolean")
    want = [(d, t) for d in ("", "a") for t in (1, 5, 6, 22, 41)]
    for slot in (None, F.floor(F.col("at") / 10), F.col("at")):
        assert sorted((r.dataset or "", r.at) for r in verdicts.changes(df, slot=slot).collect()) == want


def test_changes_of_equal_times_do_not_depend_on_the_order_of_rows(spark):
    rows = [("a", 1, True), ("a", 1, False), ("a", 12, False), ("a", 12, True), ("a", 12, None), ("a", None, True), ("a", 25, False)]
    # by time, then value: null time True; 1 False, True; 12 null, False, True; 25 False
    want = sorted([("None", "True"), ("1", "False"), ("1", "True"), ("12", "None"), ("12", "False"), ("12", "True"), ("25", "False")])
    for given in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = spark.createDataFrame(given, "dataset string, at long, healthy boolean").repartition(3)
        for slot in (None, F.floor(F.col("at") / 10)):
            assert sorted((str(r.at), str(r.healthy)) for r in verdicts.changes(df, slot=slot).collect()) == want


def test_addresses_and_networks_of_both_kinds(spark):
    import ipaddress

    good = ["10.0.0.1", "255.255.255.255", "0.0.0.0", "::", "::1", "1::", "2001:DB8::7", "2001:db8:0:1:2:3:4:5", "::ffff:10.1.2.3", "fe80::1:2:3.4.5.6", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8"]
    bad = ["256.0.0.1", "", "1.2.3", "1:2:3:4:5:6:7:8:9", "1::2::3", "1:2:3:4:5:6:7", "12345::", "g::1", ":::", "1:2:3:4:5:6:7:8::", ":1::2", "::1.2.3.999", None]
    df = spark.createDataFrame([(x,) for x in good + bad], "ip string")
    got = {r.ip: r.bits for r in df.withColumn("bits", traffic.address_bits(F.col("ip"))).collect()}
    for x in good:
        n = ipaddress.ip_address(x)
        assert got[x] == f"{n.version}:{int(n):0{n.max_prefixlen}b}", x
    assert all(got[x] is None for x in bad)
    cidrs = ["10.0.0.0/8", "0.0.0.0/0", "2001:db8::/32", "2001:db8::/64", "::/0", "10.0.0.1/32"]
    found = {r.ip: r.network for r in traffic.in_networks(df.repartition(5), "ip", traffic.networks(spark, cidrs)).collect()}
    for x in good:
        inside = [ipaddress.ip_network(c) for c in cidrs if ipaddress.ip_address(x) in ipaddress.ip_network(c)]
        assert found[x] == str(max(inside, key=lambda n: n.prefixlen)), x
    assert all(found[x] is None for x in bad)
    assert traffic.in_networks(df, "ip", traffic.networks(spark, cidrs).limit(0)).where("network is null").count() == len(good + bad)


def test_routes_by_shuffled_rules(spark):
    rules = spark.createDataFrame([(2, "GET /a", "a"), (1, "GET /a/b", "ab"), (3, "GET /a/b", "late"), (0, "POST /", "write")], "rule_no int, prefix string, category string")
    table = rules.select("prefix", F.col("rule_no").alias("rank"), F.col("category").alias("value"))
    df = spark.createDataFrame([("GET /a/b/c",), ("GET /a",), ("POST /x",), ("GET /",), (None,)], "p string")
    for limit in (100, 0):
        assert {r.p: r.value for r in traffic.by_prefix(df, F.col("p"), table, limit).collect()} == {"GET /a/b/c": "ab", "GET /a": "a", "POST /x": "write", "GET /": None, None: None}


def test_ip_numbers(spark):
    df = spark.createDataFrame([("10.0.0.1",), ("256.0.0.1",), ("::1",), (None,), ("192.168.300.1",)], "ip string")
    assert [r[0] for r in df.select(traffic.ip_number(F.col("ip"))).collect()] == [167772161, None, None, None, None]
    assert [r[0] for r in df.select(traffic.is_listed(F.col("ip"), ["10.0.0.0/8"])).collect()] == [True, False, False, False, False]
