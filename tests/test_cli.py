"""The command line, run in-process on the test session."""

import contextlib
import io
import json
import tempfile

from marlstone.__main__ import main


def _run(argv):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        assert main(argv) == 0
    return buf.getvalue()


def test_seed_run_preview_inventory(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS cli_bi_db")
    out = _run(["seed", "--database", "cli_src"])
    assert json.loads(out) == {"database": "cli_src", "sample_rows_loaded": True}
    assert json.loads(_run(["seed", "--database", "cli_src"]))["sample_rows_loaded"] is False

    root = tempfile.mkdtemp(prefix="cli-", dir=scratch)
    lines = [json.loads(l) for l in _run([
        "run", "--root", root, "--source", "catalog:cli_src",
        "--target", "catalog:cli_bi_db"]).splitlines()]
    by_stage = {}
    for line in lines:
        by_stage.setdefault(line["stage"], []).append(line)
    assert [len(by_stage[s]) for s in ("extract", "silver", "gold", "publish")] == [6, 6, 5, 5]
    gold = {l["table"]: l["row_count"] for l in by_stage["gold"]}
    assert gold["mart_session_conversion"] == 4

    shown = _run(["preview", "--root", root, "--zone", "bronze",
                  "--table", "staging_orders", "-n", "1"])
    assert "DECIMAL(12,2)" in shown and ("501" in shown or "502" in shown)

    inv = _run(["inventory", "--database", "cli_bi_db"])
    assert "gold_fact_order_items" in inv and "net_profit_usd" in inv
