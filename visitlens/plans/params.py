"""Parameters of the registered queries (one place for Spark and oracle).

The date range covers every event in the test tables, so each query runs
over the whole tables; the filters are the feature under test.
"""

import datetime as dt

from visitlens.params import TaskParams

DATE_RANGE = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))

# Sessions kept for statistics, sampling and the top-10 reports.
SESSION_PARAMS = TaskParams(start_date=DATE_RANGE[0], end_date=DATE_RANGE[1],
                            start_age=10, end_age=50)

# Every predicate kind at once.
FILTER_PARAMS = TaskParams(
    start_date=DATE_RANGE[0], end_date=DATE_RANGE[1],
    start_age=20, end_age=55,
    professionals=("AUTOMOBILE", "BUILDING", "MACHINERY", "HOUSEHOLD"),
    cities=tuple(f"city{i}" for i in range(0, 25, 2)) + ("city11", "city19"),
    sex="female",
    keywords=("kw1", "kw3", "kw5", "kw7", "kw9"),
    category_ids=tuple(range(0, 100, 3)),
)

TARGET_PAGE_FLOW = (1, 2, 3, 4, 5, 6, 7)
SAMPLE_SIZE = 1500
SAMPLE_SEED = "visitlens"
FEEDBACK_DAYS = ("2024-01-10", "2024-01-20")    # last days of the first two batches
TOP_CATEGORIES = 10
TOP_SESSIONS = 10
TOP_PRODUCTS = 3
REGION_LEVELS = {"ASIA": "A级", "EUROPE": "B级", "AMERICA": "C级"}
BLACKLIST_THRESHOLD = 5
SALT_BUCKETS = 8
TREND_WATERMARK = "11 days"                     # longer than a batch of days lasts
LATE_DELAY_MS = 5 * 86_400_000
LOG_RANGE = (dt.date(2024, 1, 8), dt.date(2024, 1, 21))
# Rows of a task table: parameters as JSON arrays of strings.
TASKS = [
    (1, '{"startDate": ["2024-01-01"], "endDate": ["2024-01-31"], '
        '"targetPageFlow": ["1,2,3,4,5,6,7"]}'),
    (2, '{"startDate": ["2024-01-08"], "endDate": ["2024-01-21"], "sex": [], "cities": [""], '
        '"targetPageFlow": ["3,5,7,3"]}'),
]
