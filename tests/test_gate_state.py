"""The state of the promotion gate, in parts of bounded size."""

from test_scale_steps import Handle, Times
from tidemark.streaming import promotions


def test_a_task_holds_no_more_new_requests_than_its_limit(monkeypatch):
    monkeypatch.setattr(promotions, "HELD", 100)
    handle, gate = Handle(), promotions.PromotionProcessor()
    gate.init(handle)
    held, keep = [], gate._keep
    monkeypatch.setattr(gate, "_keep", lambda new: (held.append(sum(map(len, new.values()))), keep(new)))
    start = 1_700_000_400_000  # where a slice begins
    rows = [{"_tick": False, "_static": None, "version": str(i), "approved_by": "a", "seq": i, "micros": (start + (i * 7919 % 1000) * 1200) * 1000,
             "metric_label": "F1", "score": i / 1000, "margin": 0.01, "floor": 0.4} for i in range(1000)]
    assert list(gate.handleInputRows(("m",), iter(rows), Times(0))) == []
    assert max(held) == 100 and sum(held) == 1000
    assert max(len(v[2]) for v in handle.values.values()) <= 100
    assert handle.timers == {start, start + 600_000}
    out = []
    for end in (start + 300_000, start + 900_000, start + 10_000_000):
        while handle.timers and min(handle.timers) <= end:
            at = min(handle.timers)
            handle.timers.discard(at)
            out += gate.handleExpiredTimer(("m",), Times(end), Times(at))
    wanted = sorted(rows, key=lambda r: r["micros"])
    assert [r["version"] for r in out] == [r["version"] for r in wanted] and not handle.values
    incumbent = None
    for r, row in zip(out, wanted, strict=True):
        assert r["incumbent_score"] == incumbent
        if row["score"] >= (0.4 if incumbent is None else incumbent + 0.01):
            incumbent = row["score"]
