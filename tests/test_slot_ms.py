import pandas as pd

from tidemark.plans.timeout_queries import _slot_ms


def test_slot_ms_is_the_largest_wall_time_in_ms():
    instants = pd.Series(pd.to_datetime([1_600_000_000_000_000_000, 1_700_000_000_123_456_789]))
    assert _slot_ms(pd.DataFrame({"slot": instants})) == 1_700_000_000_123
    assert _slot_ms(pd.DataFrame({"slot": instants.dt.tz_localize("UTC")})) == 1_700_000_000_123
    eastern = instants.dt.tz_localize("UTC").dt.tz_convert("America/New_York")
    assert _slot_ms(pd.DataFrame({"slot": eastern})) == 1_700_000_000_123 - 5 * 3_600_000
