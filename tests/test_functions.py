"""Scalar Column functions on literal rows."""

from pyspark.sql import functions as F

from harborlens import functions as hf


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def test_quantities(spark):
    assert one(spark, hf.cpu_millis(F.lit("900m"))) == 900
    assert one(spark, hf.cpu_millis(F.lit("2"))) == 2000
    assert one(spark, hf.cpu_millis(F.lit("0.5"))) == 500
    assert one(spark, hf.cpu_millis(F.lit(""))) is None
    assert one(spark, hf.memory_bytes(F.lit("128Mi"))) == 128 * 1024 ** 2
    assert one(spark, hf.memory_bytes(F.lit("1Gi"))) == 1024 ** 3
    assert one(spark, hf.memory_bytes(F.lit("500M"))) == 500 * 10 ** 6


def test_durations(spark):
    assert one(spark, hf.duration_seconds(F.lit("720h0m0s"))) == 720 * 3600
    assert one(spark, hf.duration_seconds(F.lit("7d"))) == 7 * 86400
    assert one(spark, hf.duration_seconds(F.lit("1m"))) == 60
    assert one(spark, hf.duration_seconds(F.lit("15s"))) == 15
    assert one(spark, hf.duration_seconds(F.lit("soon"))) is None


def test_ipv4_and_cidr(spark):
    assert one(spark, hf.ipv4_to_long(F.lit("10.0.1.5"))) == (10 << 24) + (1 << 8) + 5
    assert one(spark, hf.ipv4_to_long(F.lit("not-an-ip"))) is None
    assert one(spark, hf.cidr_low(F.lit("10.0.0.0/16"))) == 10 << 24
    assert one(spark, hf.cidr_high(F.lit("10.0.0.0/16"))) == (10 << 24) + 65535
    assert one(spark, hf.cidr_prefix(F.lit("10.0.1.0/24"))) == 24


def test_shell_style_defaults_and_strips(spark):
    assert one(spark, hf.default_if_empty(F.lit(""), "d")) == "d"
    assert one(spark, hf.default_if_empty(F.lit(None).cast("string"), "d")) == "d"
    assert one(spark, hf.default_if_empty(F.lit("x"), "d")) == "x"
    assert one(spark, hf.strip_trailing_dot(F.lit("example.com."))) == "example.com"
    assert one(spark, hf.strip_hosted_zone(F.lit("/hostedzone/Z123"))) == "Z123"
    assert one(spark, hf.missing_to_null(F.lit("None"))) is None


def test_tags(spark):
    tags = F.array(F.struct(F.lit("Name").alias("Key"), F.lit("a").alias("Value")),
                   F.struct(F.lit("Env").alias("Key"), F.lit("dev").alias("Value")),
                   F.struct(F.lit("Name").alias("Key"), F.lit("b").alias("Value")))
    assert one(spark, hf.tag_value(tags, "Name")) == "a"
    assert one(spark, hf.tag_value(tags, "Missing")) is None
    assert one(spark, hf.tags_to_map(tags)) == {"Name": "b", "Env": "dev"}


def test_label_merge(spark):
    old = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))
    new = F.create_map(F.lit("b"), F.lit("3"))
    assert one(spark, hf.sorted_map_json(hf.merge_labels(old, new))) == '{"a":"1","b":"3"}'


def test_image_tag(spark):
    assert one(spark, hf.image_tag(F.lit("nginx"))) == "latest"
    assert one(spark, hf.image_tag(F.lit("reg:5000/app"))) == "latest"
    assert one(spark, hf.image_tag(F.lit("reg:5000/app:v2"))) == "v2"
    assert one(spark, hf.image_tag(F.lit("app@sha256:ab"))) is None


def test_shell_and_hcl_expressions(spark):
    import datetime as dt
    assert one(spark, hf.template("s3://${BUCKET}/${ENV}/x", BUCKET=F.lit("b1"), ENV="dev")) == "s3://b1/dev/x"
    assert one(spark, hf.template("${MISSING}-a")) == "${MISSING}-a"
    azs = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    assert one(spark, hf.slice0(azs, 0, 2)) == ["a", "b"]
    assert one(spark, F.array_sort(F.array_distinct(F.array(F.lit("x"), F.lit("y"), F.lit("x"))))) == ["x", "y"]
    ts = hf.ts_literal(dt.datetime(2024, 1, 2, 3, 4, 5))
    assert one(spark, hf.compact_stamp(ts)) == "20240102030405"
    assert one(spark, hf.epoch_seconds(hf.ts_literal(dt.datetime(1970, 1, 2)))) == 86400
    assert one(spark, F.lower(F.lit("VeleroBackups"))) == "velerobackups"
    assert one(spark, F.replace(F.lit("https://oidc.example/id"), F.lit("https://"), F.lit(""))) == "oidc.example/id"
    assert one(spark, F.get(F.array().cast("array<string>"), 0)) is None
    assert one(spark, F.lit("Hello").ilike("%ELL%")) is True
    assert one(spark, F.get_json_object(F.lit('{"status":{"phase":"Completed"}}'), "$.status.phase")) == "Completed"
    assert one(spark, F.to_json(F.struct(F.lit("q").alias("queue")))) == '{"queue":"q"}'
    m = F.create_map(F.lit("a"), F.struct(F.lit("id-a").alias("id")))
    assert one(spark, F.transform_values(m, lambda k, v: v["id"])) == {"a": "id-a"}


def test_timestamp_literal_ignores_process_time_zone(spark):
    import datetime as dt
    import os
    import time
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        d = dt.datetime(2024, 1, 30, 0, 0, 0)
        assert one(spark, hf.ts_literal(d)) == d
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()


def test_ipv4_rejects_malformed(spark):
    for bad in ["10.0.1", "10.0.1.256", "10..1.2", "a.b.c.d", "1.2.3.4.5", "", "1234.1.1.1"]:
        assert one(spark, hf.ipv4_to_long(F.lit(bad))) is None, bad
    assert one(spark, hf.ipv4_to_long(F.lit("255.255.255.255"))) == 2 ** 32 - 1
    assert one(spark, hf.ipv4_to_long(F.lit("0.0.0.0"))) == 0


def test_quantity_edges(spark):
    assert one(spark, hf.cpu_millis(F.lit("5mm"))) is None
    assert one(spark, hf.cpu_millis(F.lit(" 250m "))) == 250
    assert one(spark, hf.cpu_millis(F.lit("1.5"))) == 1500
    assert one(spark, hf.cpu_millis(F.lit("m"))) is None
    assert one(spark, hf.image_tag(F.lit("reg:5000/team/app:v1:x"))) == "x"
    assert one(spark, hf.image_tag(F.lit("app:"))) == "latest"


def test_time_arithmetic_ignores_session_time_zone_across_dst(spark):
    import datetime as dt
    from harborlens.operators import sli
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t0 = dt.datetime(2024, 3, 10, 0, 0)  # clocks in New York jump 02:00 -> 03:00 this night
        rows = [("s", t0 + dt.timedelta(hours=i), 0.9) for i in range(6)]
        df = spark.createDataFrame(rows, "service string, window_start timestamp_ntz, error_ratio double")
        eps = [(r.windows, r.start_ts) for r in sli.alert_episodes(df, 0.5, 2, 3600).collect()]
        assert eps == [(6, t0)]
        gap = hf.micros_between(hf.ts_literal(t0 + dt.timedelta(hours=4)), hf.ts_literal(t0))
        assert one(spark, gap) == 4 * 3600 * 10 ** 6
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_cluster_settings_scale_with_input():
    from harborlens.session import cluster_settings
    small = cluster_settings(10 * 2 ** 30, executors=10)
    big = cluster_settings(100 * 2 ** 40, executors=1000)
    assert int(small["spark.sql.shuffle.partitions"]) == 80  # two waves of 40 cores beat 41 size-based
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2 ** 40 // (256 * 2 ** 20) + 1  # 256 MB each, whatever the size
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
