"""Where the warehouse lives, per profile.

Precedence, highest first: explicit environment settings, then profile
defaults. The ``prod`` profile is read-only unless writing is enabled
explicitly; every write operator of ``Warehouse`` refuses a read-only root.
Defaults derive from the session (``spark.sql.warehouse.dir``), never from a
machine-local folder.
"""
from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from dealhouse.plans.warehouse import Warehouse

ENV_PROFILE = "DEALHOUSE_PROFILE"
ENV_ROOT = "DEALHOUSE_WAREHOUSE"
ENV_DATA_DIR = "DEALHOUSE_DATA_DIR"
ENV_READ_ONLY = "DEALHOUSE_READ_ONLY"
PROFILES = ("local", "prod")
_TRUE = {"1", "true", "yes", "on"}
_FALSE = {"0", "false", "no", "off"}


@dataclass(frozen=True)
class WarehouseConfig:
    profile: str
    root: str
    data_dir: str
    read_only: bool


def resolve(spark: SparkSession, env: Mapping[str, str] | None = None) -> WarehouseConfig:
    env = os.environ if env is None else env
    profile = env.get(ENV_PROFILE, "local").strip().lower()
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; expected one of {PROFILES}")
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    root = env.get(ENV_ROOT) or f"{base}/dealhouse_{profile}"
    data_dir = env.get(ENV_DATA_DIR) or f"{root}/landing"
    flag = env.get(ENV_READ_ONLY, "").strip().lower()
    if flag in _TRUE:
        read_only = True
    elif flag in _FALSE:
        read_only = False
    elif flag:
        raise ValueError(f"{ENV_READ_ONLY} must be a boolean, got {flag!r}")
    else:
        read_only = profile == "prod"
    return WarehouseConfig(profile, root.rstrip("/"), data_dir.rstrip("/"), read_only)


def open_warehouse(spark: SparkSession, env: Mapping[str, str] | None = None) -> tuple[Warehouse, WarehouseConfig]:
    cfg = resolve(spark, env)
    return Warehouse(spark, cfg.root, read_only=cfg.read_only), cfg
