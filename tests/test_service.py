import datetime as dt

import pytest

from moorage.plans.annual import check_boundaries, year_windows
from moorage.sources.api import Service, ServiceError

PATHS = {k: k for k in ("report", "last_report", "events", "vessels")}


def scripted(answers):
    seen = []

    def send(method, url, params, body, timeout):
        seen.append((url, params.get("offset")))
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    waits = []
    return Service(send, PATHS, sleep=waits.append), seen, waits


def test_pages_are_asked_for_again_at_the_same_offset():
    page = lambda i, n: (200, {"entries": [{"id": i}], "nextOffset": n})
    service, seen, waits = scripted([TimeoutError(), (503, {}), page("a", 1), ConnectionError(), page("b", None)])
    assert [e["id"] for e in service.events({}, "x", "y", "d")] == ["a", "b"]
    assert [o for _, o in seen] == [0, 0, 0, 1, 1] and waits == [10, 20, 10]


def test_five_attempts_and_no_retry_of_refusals():
    service, seen, _ = scripted([(503, {})] * 9)
    with pytest.raises(ServiceError):
        list(service.events({}, "x", "y", "d"))
    assert len(seen) == 5
    service, seen, _ = scripted([(401, {})] * 9)
    with pytest.raises(ServiceError):
        list(service.events({}, "x", "y", "d"))
    assert len(seen) == 1


def test_reports_are_waited_for():
    for first in (TimeoutError(), (524, {}), (429, {})):
        service, seen, _ = scripted([first, (404, {}), (200, {"status": "running"}), (200, {"entries": []})])
        assert service.report({}, {}) == {"entries": []} and len(seen) == 4
    service, _, _ = scripted([(504, {}), (200, {"status": 500})])
    with pytest.raises(ServiceError):
        service.report({}, {})
    service, _, _ = scripted([(504, {})] + [(404, {})] * 40)
    with pytest.raises(TimeoutError):
        service.report({}, {})


def test_years():
    today = dt.date(2026, 9, 20)
    assert [y for y, _, _ in year_windows(2019, today=today)] == list(range(2019, 2026))
    assert year_windows(2025, end_date="2026-09-01", today=today)[-1] == (2026, "2026-01-01", "2026-09-01")
    for bad in ({"end_year": 2026}, {"end_date": "2026-09-02"}, {"end_date": "2026-10-01"}, {"end_year": 2020, "end_date": "2021-01-01"}, {"end_date": "never"}, {"end_year": 2018}):
        with pytest.raises(ValueError):
            year_windows(2019, today=today, **bad)
    with pytest.raises(ValueError):
        check_boundaries({"features": [{"properties": {}}]})
