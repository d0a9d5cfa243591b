"""All check statements by query name."""

from __future__ import annotations

from oracle import reports_a, reports_b, reports_c, reports_d


def all_statements() -> dict[str, str]:
    return {**reports_a.SQL, **reports_b.SQL, **reports_c.SQL, **reports_d.SQL}
