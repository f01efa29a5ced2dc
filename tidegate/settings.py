"""Where a lake is and how strictly it reconciles, from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

from tidegate.plans.layers import Lake


def lake_from(spark: SparkSession, env: Mapping[str, str] = os.environ) -> Lake:
    """The lake that the environment names.

    LAKE_WAREHOUSE is the root of all tables, below it LAKE_CATALOG and LAKE_ENV, where set, name folders. LAKE_LANDING_URI,
    LAKE_QUARANTINE_URI and LAKE_CTL_URI place those stores elsewhere; LAKE_RECON_THRESHOLD_PCT is the tolerance in percent.
    """
    if not env.get("LAKE_WAREHOUSE"):
        raise KeyError("LAKE_WAREHOUSE")
    root = "/".join([env["LAKE_WAREHOUSE"].rstrip("/"), *(env[k].strip("/") for k in ("LAKE_CATALOG", "LAKE_ENV") if env.get(k))])
    return Lake(spark, root, float(env.get("LAKE_RECON_THRESHOLD_PCT") or 0.01), env.get("LAKE_LANDING_URI"), env.get("LAKE_QUARANTINE_URI"), env.get("LAKE_CTL_URI"))
