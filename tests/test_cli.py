"""The modes of the command line over a small log written here."""

import json

import pytest

from tidelog import __main__ as cli
from tidelog.plans.fixtures import write_customers


@pytest.fixture
def place(spark, tmp_path):
    rows = [(i, f"n{i}" if i % 4 else None, i % 25, i * 1.25, ("BUILDING", "MACHINERY")[i % 2]) for i in range(1, 41)]
    df = spark.createDataFrame(rows, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    assert write_customers(df.repartition(2), f"file://{tmp_path}/log") == 40
    (tmp_path / "settings.yaml").write_text(f"root: file://{tmp_path}/data\nlog_level: error\nrows_per_file: 15\n")
    return tmp_path


def test_run_optimize_monitor_read(spark, place, capsys):
    base = ["--config", str(place / "settings.yaml")]
    assert cli.main(["run", *base, "--log", str(place / "log")]) == 0
    assert cli.main(["run", *base, "--log", str(place / "log")]) == 0  # nothing new
    assert cli.main(["optimize", *base]) == 0
    capsys.readouterr()
    cli.main(["monitor", *base, "--log", f"file://{place}/log"])
    report = json.loads(capsys.readouterr().out)
    assert report["tables"] == 1 and report["files_behind"] == 0 and report["applied"] == report["log"]
    cli.main(["read", *base, "--table", "shop.customer"])
    rows = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    cli.main(["read", *base, "--sql", "SELECT segment, count(*) AS n FROM shop_customer GROUP BY ALL ORDER BY segment"])
    assert [json.loads(x) for x in capsys.readouterr().out.splitlines()] == [{"segment": "building", "n": 20}, {"segment": "machinery", "n": 20}]
    assert len(rows) == 40 and {r["id"]: r for r in rows}[5] == {"id": 5, "name": "n5", "nation": 5, "balance": 6.25, "price": 6.25, "segment": "machinery", "extra": '{"n":5}'}


def test_queue(spark, place):
    assert cli.main(["queue", "--config", str(place / "settings.yaml"), "--log", str(place / "log")]) == 0
    q = spark.read.format("tidelog_queue").option("path", f"file://{place}/data/queue").load()
    assert q.where("event_type = 1").count() == 40 and q.where("event_type = 3").count() == 2 and q.select("file_num").distinct().count() >= 3
    assert json.loads(q.where("event_type = 1").first().records)[0][-1] == '{"n":' + str(int(json.loads(q.where("event_type = 1").first().records)[0][2])) + "}"


def test_arguments(place):
    with pytest.raises(SystemExit):
        cli.main(["run"])
    with pytest.raises(SystemExit, match="--log"):
        cli.main(["run", "--config", str(place / "settings.yaml")])
