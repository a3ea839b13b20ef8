"""Queries that bring several audits or files together."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators.lint import joint_report
from quarry.operators.scan import first_keys, write_ranges
from quarry.plans import curation, governance, scalars
from quarry.plans.base import Plans
from quarry.session import shared_dir, table

plans = Plans()

AUDITS = {"coverage": (governance, "ledger_join", "code"), "integrity": (scalars, "vector_integrity", "code"), "freshness": (governance, "freshness_audit", "code"), "quality": (curation, "quarantine_split", "reason")}


@plans.add("generation_report", " UNION ALL ".join(f"SELECT '{a}' AS audit, coalesce(code, 'ok') AS code, n FROM (SELECT 1) LEFT JOIN (SELECT {c} AS code, count(*) AS n FROM ({m.plans.oracle[q]}) GROUP BY 1) ON true" for a, (m, q, c) in AUDITS.items()))
def generation_report(s, d):
    """Coverage against the ledger, vectors, freshness and body quality in one report: findings by audit and code."""
    return joint_report({a: m.plans.queries[q](s, d).select(F.col(c).alias("code")) for a, (m, q, c) in AUDITS.items()})


@plans.add("early_stop_scan", "SELECT l_suppkey, (x).o AS l_orderkey, (x).l AS l_linenumber FROM (SELECT l_suppkey, min({'o': l_orderkey, 'l': l_linenumber}) AS x FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY 1) ORDER BY x LIMIT 40")
def early_stop_scan(s, d):
    """The first 40 suppliers in order of the order lines: of 16 files only as many are read as it takes."""
    path = f"{shared_dir(s)}/quarry/ranges-{uuid.uuid4().hex}"
    write_ranges(table(s, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber"), path, ["l_orderkey", "l_linenumber"], 16)
    return first_keys(s, path, "l_suppkey long, l_orderkey long, l_linenumber int", "l_suppkey", ["l_orderkey", "l_linenumber"], 40)[0]
