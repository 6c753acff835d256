import datetime as dt
import random
from collections import defaultdict
from fractions import Fraction

import pytest

from riskledger.operators.spikes import added_up, spikes, window_counts
from riskledger.streaming.payments import read_payment_stream
from riskledger.streaming.spikes import current_spikes, spikes_after, write_window_counts

EPOCH = dt.date(1970, 1, 1)


def payment(number, merchant, day, fraud):
    at = None if day is None else dt.datetime(2024, 1, 1, 23, 59) + dt.timedelta(days=day)
    return {
        "transaction_id": f"T{number}",
        "merchant_id": merchant,
        "transaction_datetime": at,
        "is_fraud": fraud,
    }


def random_payments(seed, n):
    rnd = random.Random(seed)
    return [
        payment(
            i,
            rnd.choice(["A", "A", "A", "B", "C", None]),
            rnd.choice([None, *range(40)]) if rnd.random() < 0.9 else 3,
            rnd.choice([None, 0, 0, 0, 0, 1]) if rnd.random() < 0.8 else 1,
        )
        for i in range(n)
    ]


def expected(rows, days, baseline, least, factor):
    """Alerts by plain loops over the payments."""
    cells = defaultdict(lambda: [0, 0])
    for row in rows:
        if row["transaction_datetime"] is not None and row["is_fraud"] is not None:
            number = (row["transaction_datetime"].date() - EPOCH).days // days
            cells[row["merchant_id"], number][0] += 1
            cells[row["merchant_id"], number][1] += row["is_fraud"]
    alerts = set()
    for (merchant, number), (n, frauds) in cells.items():
        past = [cells[merchant, k] for k in range(number - baseline, number) if (merchant, k) in cells]
        total = sum(p for p, _ in past)
        if total and frauds >= least:
            share = Fraction(sum(f for _, f in past), total)
            if Fraction(frauds, n) >= factor * share:
                alerts.add((merchant, number, n, frauds))
    return alerts


def found(df):
    rows = [(r.merchant_id, r.window_number, r.payments, r.frauds) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("days, baseline, least, factor", [(1, 3, 2, 1), (7, 4, 3, 2), (2, 1, 1, 3)])
def test_equals_plain_loops(clean, days, baseline, least, factor):
    rows = random_payments(days, 400)
    alerts = spikes(window_counts(clean(*rows), days), days, baseline, least, factor)
    wanted = expected(rows, days, baseline, least, factor)
    assert found(alerts) == wanted
    assert wanted or days != 1


def test_shares_that_tie_and_pasts_that_are_missing(clean):
    rows = [payment(i, "tie", 0, int(i < 1)) for i in range(4)]
    rows += [payment(10 + i, "tie", 1, int(i < 2)) for i in range(4)]
    rows += [payment(20 + i, "under", 0, int(i < 1)) for i in range(4)]
    rows += [payment(30 + i, "under", 1, int(i < 2)) for i in range(5)]
    rows += [payment(40 + i, "new", 1, 1) for i in range(5)]
    rows += [payment(50 + i, "first", d, d) for i, d in enumerate((0, 1, 1))]
    alerts = spikes(window_counts(clean(*rows), 1), 1, 4, 2, 2)
    assert {r.merchant_id: (str(r.window_start), r.fraud_rate_pct, r.past_fraud_rate_pct)
            for r in alerts.collect()} == {
        "tie": ("2024-01-02", 50.0, 25.0),
        "first": ("2024-01-02", 100.0, 0.0),
    }


def test_empty_table(clean):
    assert spikes(window_counts(clean({}).limit(0))).count() == 0


def test_counts_of_parts_add_up(clean):
    rows = random_payments(5, 60)
    whole = window_counts(clean(*rows), 2)
    parts = window_counts(clean(*rows[:25]), 2).unionByName(window_counts(clean(*rows[25:]), 2))
    assert sorted(map(str, added_up(parts).collect())) == sorted(map(str, whole.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_files_gives_the_alerts_of_the_batch(spark, payments, tmp_path, seed):
    rows = random_payments(9, 120)
    late = rows[:]
    random.Random(seed).shuffle(late)
    folder, out, state = (str(tmp_path / x) for x in ("arriving", "counts", "state"))
    rule = {"days": 2, "baseline": 3, "least": 2, "factor": 1}
    for at in range(0, 120, 40):
        # Every file also repeats payments of an earlier one.
        some = [*late[at : at + 40], *late[max(0, at - 10) : at]]
        payments(*some).coalesce(1).write.mode("append").parquet(folder)
        stream = read_payment_stream(spark, folder)
        write_window_counts(stream, out, state, days=2).awaitTermination()
        so_far = expected(late[: at + 40], **rule)
        assert found(current_spikes(spark, out, **rule)) == so_far
        if at:
            changed = so_far - expected(late[:at], **rule)
            assert changed <= found(spikes_after(spark, out, at // 40, **rule)) <= so_far
    assert so_far == expected(rows, **rule)
