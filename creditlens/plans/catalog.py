"""Imports every plan module so its queries register, and exposes the registry."""

from __future__ import annotations

from creditlens.plans import allocation_plans, batch_plans, bundle_plans, contracts_plans, explain_plans, extra_plans, gap_plans, io_plans, summary_plans, evaluation, explorer_plans, features, harmonize_plans, resample_plans, monitoring, pilot_ledger, policy_plans, portfolio, protocol_plans, recipe_plans, stage_plans  # noqa: F401
from creditlens.plans.registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
