from docferry.plans.apply import apply_plan, apply_plan_checked, reject_rows
from docferry.plans.ddl import render_additions, render_ddl
from docferry.plans.infer import collect_profile, diff_schema, infer_plan, plan_columns, plan_documents

__all__ = [
    "apply_plan",
    "apply_plan_checked",
    "collect_profile",
    "diff_schema",
    "infer_plan",
    "plan_columns",
    "plan_documents",
    "reject_rows",
    "render_additions",
    "render_ddl",
]
