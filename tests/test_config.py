import pytest

from dealhouse.plans.config import open_warehouse, resolve
from dealhouse.plans.warehouse import ReadOnlyWarehouse


def test_profiles_and_precedence(spark):
    local = resolve(spark, {})
    assert local.profile == "local" and not local.read_only and local.root.endswith("dealhouse_local")
    prod = resolve(spark, {"DEALHOUSE_PROFILE": "prod"})
    assert prod.read_only and prod.data_dir == prod.root + "/landing"
    custom = resolve(spark, {"DEALHOUSE_PROFILE": "prod", "DEALHOUSE_WAREHOUSE": "/x/wh/",
                             "DEALHOUSE_DATA_DIR": "/in", "DEALHOUSE_READ_ONLY": "0"})
    assert (custom.root, custom.data_dir, custom.read_only) == ("/x/wh", "/in", False)
    with pytest.raises(ValueError):
        resolve(spark, {"DEALHOUSE_PROFILE": "staging"})


def test_prod_refuses_writes(spark, tmp_root):
    wh, _ = open_warehouse(spark, {"DEALHOUSE_PROFILE": "prod", "DEALHOUSE_WAREHOUSE": tmp_root})
    with pytest.raises(ReadOnlyWarehouse):
        wh.write("raw", "x", spark.range(1))
