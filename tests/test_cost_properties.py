"""C1/C2 over random parameters against a plain statement of the rules."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from webledger.operators import cost

RATES = cost.BASE_CREDITS


def expected(tool, formats, limit, ttl, with_scrape):
    base = RATES.get(tool, 1)
    if tool == "scrape":
        f = formats if formats is not None else ["markdown"]
        c = base + (4 if "json" in f else 0) + (1 if "screenshot" in f else 0)
        return c, "map + scrape", max(0, c - 2)
    if tool == "crawl":
        lim = 100 if limit is None else limit
        c = lim * base
        return c, "map + selective scrape", max(0, c - math.ceil(lim * 0.2) - 1)
    if tool == "search":
        lim = 10 if limit is None else limit
        c = math.ceil(lim / 10) * 2
        extra = lim if with_scrape else 0
        return c + extra, ("search without scrapeOptions" if with_scrape else None), extra
    if tool == "map":
        return 1, None, None
    if tool == "interact":
        t = 300 if ttl is None else ttl
        c = math.ceil(t / 60) * base
        return c, "scrape with actions", max(0, c - 1)
    return base, None, None


params = st.tuples(
    st.sampled_from(list(RATES) + ["search", "unknown"]),
    st.one_of(st.none(), st.lists(st.sampled_from(["markdown", "json", "screenshot", "links"]), max_size=3)),
    st.one_of(st.none(), st.integers(min_value=0, max_value=5000)),
    st.one_of(st.none(), st.integers(min_value=0, max_value=3600)),
    st.booleans(),
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(params, min_size=1, max_size=40))
def test_estimates_match_rules(spark, rows):
    df = spark.createDataFrame(rows, "tool string, formats array<string>, limit int, ttl int, with_scrape boolean")
    got = [(r.estimated_credits, r.cheaper_alternative, r.alternative_savings) for r in cost.estimate_cost(df).collect()]
    assert got == [expected(*r) for r in rows]
