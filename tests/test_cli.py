import json

from starloom.__main__ import main
from starloom.session import scratch_path
from tests.sample_source import base_source, changed_source


def test_cli_workflow(spark, capsys):
    src_dir, src2_dir = scratch_path(spark, "cli-src"), scratch_path(spark, "cli-src2")
    src = base_source(spark)
    for t, df in src.tables().items():
        df.write.parquet(f"{src_dir}/{t}")
    for t, df in changed_source(spark, src).tables().items():
        df.write.parquet(f"{src2_dir}/{t}")
    wh = scratch_path(spark, "cli-wh")
    assert main(["init", "--warehouse", wh]) == 0
    assert main(["full", "--warehouse", wh, "--source", src_dir]) == 0
    assert main(["incremental", "--warehouse", wh, "--source", src2_dir, "--effective-date", "2023-03-15"]) == 0
    out = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()]
    assert [o["run_type"] for o in out] == ["INIT", "FULL", "INCREMENTAL"]
    assert out[-1]["watermark"] == 59
    assert main(["validate", "--warehouse", wh, "--source", src2_dir, "--strict"]) == 0
    checks = json.loads(capsys.readouterr().out)
    assert all(c["violations"] == 0 for c in checks)
    assert main(["runs", "--warehouse", wh]) == 0
    runs = json.loads(capsys.readouterr().out)
    assert [r["run_id"] for r in runs] == ["2", "1"]
    assert main(["expire", "--warehouse", wh, "--keep", "1"]) == 0
    assert any("dim_customer" in p for p in json.loads(capsys.readouterr().out)["removed"])
    assert main(["validate", "--warehouse", wh, "--source", src2_dir, "--strict"]) == 0
