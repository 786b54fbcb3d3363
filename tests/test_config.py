from pyspark.sql import functions as F

from shiplog.functions.predicates import valid_app_id
from shiplog.operators import config as cfg
from shiplog.sources.config_files import read_config, read_config_folders, with_overrides, write_config_folders


def test_app_id(spark):
    df = spark.createDataFrame([("a",), ("A-1_b",), ("1a",), ("",), ("a b",), ("a\n",), (None,)], "x string")
    got = {r["x"]: r["ok"] for r in df.select("x", valid_app_id("x").alias("ok")).collect()}
    assert got == {"a": True, "A-1_b": True, "1a": False, "": False, "a b": False, "a\n": False, None: False}


def test_override_syntax(spark):
    texts = ["cfg_x=", "cfg_x1=a", "cfg_x=a=b", "cfg_x=a b", "foo_x=1", "dpltgt_a_db=db1"]
    df = spark.createDataFrame([("e", i, t) for i, t in enumerate(texts)], "env string, ord int, text string")
    got = {r["text"]: (r["is_valid"], r["key"], r["value"]) for r in cfg.parse_overrides(df).collect()}
    assert got["cfg_x="] == (True, "cfg_x", "")
    assert got["dpltgt_a_db=db1"] == (True, "dpltgt_a_db", "db1")
    for bad in ("cfg_x1=a", "cfg_x=a=b", "cfg_x=a b", "foo_x=1"):
        assert got[bad][0] is False


def test_targets_greedy_and_atomic_wins(spark):
    rows = [
        ("e", 0, 1, "dpltgt_a_db_user", "u"),  # greedy: target a_db
        ("e", 0, 2, "dpltgt_b_tech", "x"),  # _tech alone: not listed
        ("e", 0, 3, "dbgrp_c", "x"),
        ("e", 0, 4, "dpltgt_c_db", "d"),  # both kinds: atomic
        ("e", 0, 5, "dbgrp_g", "x"),
    ]
    df = spark.createDataFrame(rows, "env string, layer int, ord int, key string, value string")
    got = {r["target"]: (r["kind"], r["label"], r["target_no"]) for r in cfg.target_list(df).collect()}
    assert got == {
        "a_db": ("atomic", "    * a_db", 1),
        "c": ("atomic", "    * c", 2),
        "g": ("composite", "    * g (composite)", 3),
    }


def test_last_wins_ignores_row_order(spark):
    rows = [("e", 0, 1, "k", "a"), ("e", 0, 2, "k", "b"), ("e", 1, 0, "k", "c"), ("e", 0, 3, "j", "x")]
    df = spark.createDataFrame(rows, "env string, layer int, ord int, key string, value string")
    a = sorted(map(tuple, cfg.effective_config(df).collect()))
    b = sorted(map(tuple, cfg.effective_config(df.orderBy(F.rand(3)).repartition(3)).collect()))
    assert a == b == [("e", "j", "x"), ("e", "k", "c")]


def test_change_report_masks_secrets(spark):
    rows = [("e", 0, 1, "dpltgt_a_password", "old"), ("e", 1, 0, "dpltgt_a_password", "new"), ("e", 1, 1, "dpltgt_a_db", "d")]
    df = spark.createDataFrame(rows, "env string, layer int, ord int, key string, value string")
    got = {r["key"]: (r["value"], r["base_value"], r["overridden"], r["n_overrides"]) for r in cfg.change_report(df).collect()}
    assert got == {"dpltgt_a_password": ("*****", "*****", True, 2), "dpltgt_a_db": ("d", None, True, 2)}


def test_techs_in_use(spark):
    rows = [("e", "dpltgt_a_tech", "spark-sql "), ("e", "DPLTGT_B_TECH", ""), ("e", "deploy_repo_tech", "x-repo")]
    df = spark.createDataFrame(rows, "env string, key string, value string")
    got = [(r["tech"], r["tech_no"]) for r in cfg.techs_in_use(df).orderBy("tech_no").collect()]
    assert got == [("oracle-sqlplus", 1), ("spark-sql", 2), ("x-repo", 3)]


def test_read_config_files(spark, tmp_path):
    (tmp_path / "dev.cfg").write_text("# comment\ncfg_app_id=app1\nexport dpltgt_a_db='db one'\n\ndpltgt_a_db=db2\n")
    (tmp_path / "run_deploy.cfg").write_text('cfg_app_id="x"\r\n')
    conf = read_config(spark, str(tmp_path / "*.cfg"))
    got = sorted((r["env"], r["ord"], r["key"], r["value"]) for r in conf.collect())
    assert got == [
        ("as-set", 1, "cfg_app_id", "x"),
        ("dev", 2, "cfg_app_id", "app1"),
        ("dev", 3, "dpltgt_a_db", "db one"),
        ("dev", 5, "dpltgt_a_db", "db2"),
    ]
    ovr = spark.createDataFrame([("dev", 1, "dpltgt_a_db=db3"), ("dev", 2, "bad=1")], "env string, ord int, text string")
    eff = {(r["env"], r["key"]): r["value"] for r in cfg.effective_config(with_overrides(conf, ovr)[0]).collect()}
    assert eff[("dev", "dpltgt_a_db")] == "db3"


def test_split_override_struct(spark):
    from shiplog.functions.predicates import split_override

    df = spark.createDataFrame([("cfg_a=b=c",)], "t string")
    r = df.select(split_override("t").alias("kv")).collect()[0]["kv"]
    assert (r["key"], r["value"]) == ("cfg_a", "b=c")


def test_config_folders_in_many_parts(spark, tmp_path):
    """One environment over several part files and splits keeps its order."""
    rows = [("hot", 0, 2 * i, f"k{i % 50}", f"v{i}") for i in range(3000)] + [("5", 0, 1, "a", "x"), ("5", 1, 2, "a", "no"), ("as-set", 0, 1, "b", "'q'")]
    config = spark.createDataFrame(rows, "env string, layer int, ord int, key string, value string")
    root = str(tmp_path / "conf")
    write_config_folders(config.repartition(6), root)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = read_config_folders(spark, root).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    hot = sorted((r["ord"], r["key"], r["value"]) for r in got if r["env"] == "hot")
    assert hot == [(i + 1, f"k{i % 50}", f"v{i}") for i in range(3000)]
    assert sorted((r["env"], r["ord"], r["key"], r["value"]) for r in got if r["env"] != "hot") == [("5", 1, "a", "x"), ("as-set", 1, "b", "'q'")]


def test_files_of_many_environments(spark, tmp_path):
    """As many files as tasks, not as environments; names of any kind."""
    names = [f"e{i}" for i in range(500)] + ["a/b=c", "tab\there", "+ %2B", None]
    rows = [(e, 0, i, f"k{i}", f"v{e}") for e in names for i in (3, 5, 9)] + [("nulls", 0, 1, None, "x"), ("nulls", 0, 2, "k", "x")]
    config = spark.createDataFrame(rows, "env string, layer int, ord int, key string, value string")
    root = tmp_path / "conf"
    write_config_folders(config, str(root))
    assert len(list(root.rglob("part-*"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = sorted(((r["env"] or "", r["ord"], r["key"], r["value"]) for r in read_config_folders(spark, str(root)).collect()))
    want = [(e or "", n, f"k{i}", f"v{e}") for e in names for n, i in enumerate((3, 5, 9), 1)] + [("nulls", 2, "k", "x")]
    assert got == sorted(want)


def test_line_numbers_of_split_files(spark, tmp_path):
    text = "# head\r\n" + "".join(f"k{i}=v{i}\n\n" for i in range(500)) + "last=1"
    (tmp_path / "big.cfg").write_text(text, newline="")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        got = sorted((r["ord"], r["key"]) for r in read_config(spark, str(tmp_path / "*.cfg")).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert got == [(2 * i + 2, f"k{i}") for i in range(500)] + [(1002, "last")]
