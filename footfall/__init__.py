"""Clickstream analytics as PySpark DataFrame and Structured Streaming operators."""

from footfall.params import TaskParams, task_params_from_json
from footfall.session import build_session, configure

__all__ = ["TaskParams", "build_session", "configure", "task_params_from_json"]
