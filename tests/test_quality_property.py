"""Property test: the quality reason chain equals a plain-Python statement
of the same rules on random rows (edge values included)."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderlens import schemas as S
from orderlens.operators import quality as Q
from tests.helpers import events

AS_OF = dt.datetime(2024, 6, 1, 12, 0)
TYPES = list(S.VALID_EVENT_TYPES) + ["bogus", None]
TOTALS = st.one_of(st.none(), st.just(math.nan), st.sampled_from([0.0, 0.01, 50000.0, 50000.01, -1.0]),
                   st.floats(min_value=-10, max_value=60000, allow_nan=False))
OFFSETS = st.one_of(st.none(), st.sampled_from([300, 301, -86400, -86401]),
                    st.integers(min_value=-3 * 86400, max_value=3600))


def expected(order_id, etype, total, offset):
    ts = None if offset is None else AS_OF + dt.timedelta(seconds=offset)
    if order_id is None:
        return "null_order_id"
    if etype == "order_created" and (total is None or (not math.isnan(total) and total <= 0)):
        return "invalid_total_amount"
    if etype is not None and etype not in S.VALID_EVENT_TYPES:
        return "invalid_event_type"
    if total is not None and (math.isnan(total) or total < 0.01 or total > 50000):
        return "revenue_out_of_bounds"
    if ts is not None and ts > AS_OF + dt.timedelta(minutes=5):
        return "timestamp_in_future"
    if ts is not None and ts < AS_OF - dt.timedelta(hours=24):
        return "timestamp_too_old"
    return "valid"


ROW = st.tuples(st.one_of(st.none(), st.just(""), st.just("o1")), st.sampled_from(TYPES), TOTALS, OFFSETS)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=50, max_size=120))
def test_reason_chain_matches_python(spark, rows):
    data = [{"event_id": f"{i:04d}", "order_id": o, "event_type": e, "total": t,
             "ts": None if off is None else AS_OF + dt.timedelta(seconds=off)} for i, (o, e, t, off) in enumerate(rows)]
    got = Q.check_events(events(spark, data), as_of=AS_OF).orderBy("event_id").collect()
    assert [r.quality_check_result for r in got] == [expected(*row) for row in rows]
