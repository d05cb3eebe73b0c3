from .progress import Progress, ProgressLog, progress_log
from .runner import Flow, await_any, run_available, start
from .state import cost_state

__all__ = ["Flow", "Progress", "ProgressLog", "await_any", "cost_state", "progress_log", "run_available", "start"]
