import pytest

from starloom.plans.loads import full_load, incremental_load
from starloom.plans.warehouse import FACT_TABLE, Warehouse, sketch_path
from starloom.schemas import WAREHOUSE_TABLES
from starloom.session import list_folder, scratch_path
from tests.sample_source import EFF, TS, base_source, changed_source


def state(wh, m):
    return {t: sorted(map(repr, wh.table(t, m).collect())) for t in WAREHOUSE_TABLES if any(k.split("#")[0] == t for k in m.parts)}


def folders(spark, root):
    return set(list_folder(spark, f"{root}/runs"))


def test_only_what_old_runs_used_goes(spark):
    root = scratch_path(spark, "expire")
    base = base_source(spark)
    m1 = full_load(spark, base, root, TS)
    m2 = incremental_load(spark, changed_source(spark, base), root, EFF, TS)
    wh = Warehouse(spark, root)
    wh.write_part(2, "dim_date", wh.table("dim_date", m2), tag="lost")  # an attempt that ended without a trace
    wh.write_part(3, "dim_date", wh.table("dim_date", m2), tag="running")  # a run that isn't published yet
    before = state(wh, m2)
    assert wh.expire(keep=2) == [f"2-{wh.attempt}"]
    assert state(wh, m1) and state(wh, m2) == before

    gone = wh.expire(keep=1)
    replaced = {p.split("/runs/")[1] for paths in m1.parts.values() for p in paths} - {p.split("/runs/")[1] for paths in m2.parts.values() for p in paths}
    assert replaced and {p for p in gone} >= {p for p in replaced if not any(p.startswith(f"{g}/") for g in gone)}
    assert not any(list_folder(spark, f"{root}/runs/{p}") for p in replaced)
    assert state(wh, m2) == before
    assert all(list_folder(spark, sketch_path(p)) for p in m2.parts[FACT_TABLE])
    with pytest.raises(RuntimeError, match="never published"):
        wh.manifest(1)
    assert f"3-{wh.attempt}" in folders(spark, root)
    assert wh.expire(keep=0) == []  # the newest run always stays

    m3 = full_load(spark, base, root, TS)  # everything but the log is replaced
    wh.expire(keep=1)
    assert {p.split("/runs/")[1].split("-")[0] for paths in m3.parts.values() for p in paths if "run_log" not in p} == {"3"}
    assert not any(f.startswith(("1-", "2-")) and set(list_folder(spark, f"{root}/runs/{f}")) - {n for n in list_folder(spark, f"{root}/runs/{f}") if "run_log" in n} for f in folders(spark, root))
