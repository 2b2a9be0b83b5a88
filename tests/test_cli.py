import json

from dealhouse import cli
from dealhouse.model import Model
from dealhouse.operators import staging as stg
from dealhouse.operators.rules import ALL_CHECKS
from dealhouse.session import scratch_dir
from dealhouse.sources.csv import write_csv

SF = "/root/testdata/sf0.001"


def test_cli_refresh_checks_export_reset(spark, monkeypatch, capsys):
    root = scratch_dir(spark, "cli")
    monkeypatch.setenv("DEALHOUSE_PROFILE", "local")
    monkeypatch.setenv("DEALHOUSE_WAREHOUSE", root)
    m = Model(spark, SF)
    for n in stg.STAGERS:
        write_csv(m.raw(n), f"{root}/landing/{n}.csv")

    def run(*args):
        assert cli.main(list(args)) == 0
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    out = run("refresh")
    assert out["raw.transactions"] == m.raw("transactions").count()
    assert run("incremental")["raw.targets"] > 0       # first snapshot: everything is new
    assert run("incremental") == {}                     # unchanged files: no work
    assert cli.main(["checks"]) == 1                    # no reference tables: some checks are not run, and say so
    checks = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert checks["chk_transactions_unique"] > 0 and "no table nation" in checks["chk_allowed_matrix"]
    for name, table in m.reference_tables().items():
        write_csv(table, f"{root}/landing/reference/{name}")
    checks = run("checks")
    assert all(isinstance(n, int) for n in checks.values()) and checks.keys() >= {c.name for c in ALL_CHECKS.checks}
    manifest = run("export", f"{root}/export")
    assert manifest["fct_transactions"] == out["analytics.fct_transactions"]
    assert run("reset")["dropped"] == ["analytics", "staging", "raw"]
