from .pipelines import COMMITTED, LANDED, PIPELINES, cost_cascade, cost_deltas, landed_checked, landed_costs

__all__ = ["COMMITTED", "LANDED", "PIPELINES", "cost_cascade", "cost_deltas", "landed_checked", "landed_costs"]
