"""Task parameters.

A task row holds its parameters as JSON text whose values are arrays of
strings; only element 0 of each array is used, and an empty string counts
as unset. Multi-valued parameters are comma-separated inside that string.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

# Parameter keys of a task (fixed values).
START_DATE = "startDate"
END_DATE = "endDate"
START_AGE = "startAge"
END_AGE = "endAge"
PROFESSIONALS = "professional"
CITIES = "cities"
SEX = "sex"
KEYWORDS = "keywords"
CATEGORY_IDS = "categoryIds"
TARGET_PAGE_FLOW = "targetPageFlow"


def _csv(value: str | None) -> tuple[str, ...] | None:
    if value is None or value == "":
        return None
    return tuple(v for v in value.split(",") if v != "")


@dataclass(frozen=True)
class TaskParams:
    start_date: dt.date | None = None
    end_date: dt.date | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[int, ...] | None = None
    target_page_flow: tuple[int, ...] | None = None

    @classmethod
    def from_strings(cls, values: dict[str, str | None]) -> "TaskParams":
        """Build from the element-0 strings; '' behaves as unset."""
        def get(key):
            v = values.get(key)
            return None if v is None or v == "" else v

        def date(key):
            v = get(key)
            return dt.date.fromisoformat(v) if v else None

        def integer(key):
            v = get(key)
            return int(v) if v is not None else None

        cats = _csv(get(CATEGORY_IDS))
        flow = _csv(get(TARGET_PAGE_FLOW))
        return cls(
            start_date=date(START_DATE),
            end_date=date(END_DATE),
            start_age=integer(START_AGE),
            end_age=integer(END_AGE),
            professionals=_csv(get(PROFESSIONALS)),
            cities=_csv(get(CITIES)),
            sex=get(SEX),
            keywords=_csv(get(KEYWORDS)),
            category_ids=tuple(int(c) for c in cats) if cats else None,
            target_page_flow=tuple(int(p) for p in flow) if flow else None,
        )

    @classmethod
    def from_json(cls, text: str) -> "TaskParams":
        raw = json.loads(text) if text else {}
        first = {}
        for key, value in raw.items():
            if isinstance(value, list):
                first[key] = str(value[0]) if value else None
            elif value is not None:
                first[key] = str(value)
        return cls.from_strings(first)


TASK_PARAM_TYPE = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


def params_from_task(tasks: DataFrame, task_id: int) -> TaskParams:
    """Read one task's parameters from a ``task`` table.

    Only the single parameter row of ``task_id`` reaches the driver.
    Raises ``KeyError`` for an unknown task.
    """
    parsed = (tasks.where(F.col("task_id") == F.lit(task_id))
              .select(F.from_json("task_param", TASK_PARAM_TYPE).alias("p"))
              .select(F.map_from_entries(F.transform(
                  F.map_entries("p"),
                  lambda e: F.struct(e["key"], F.get(e["value"], 0)))).alias("p"))
              .limit(2).collect())
    if not parsed:
        raise KeyError(f"no task with id {task_id}")
    if len(parsed) > 1:
        raise ValueError(f"task id {task_id} is not unique")
    return TaskParams.from_strings(dict(parsed[0]["p"] or {}))
