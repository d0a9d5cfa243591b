"""License scans against the longest common subsequence of the template with every window of a text."""

import random

import numpy as np
import pytest
from cases import prose

from ventaria.llm import licenses
from ventaria.llm.decontam import hashes_of

NAMES = ("MIT-notice", "Apache-2.0-header", "GPL-3.0-header", "BSD-3-Clause")


def common(window, template):
    """Length of the longest common subsequence, a bit for each template word."""
    places = {}
    for k, w in enumerate(template):
        places[w] = places.get(w, 0) | 1 << k
    whole = open_ = (1 << len(template)) - 1
    for w in window:
        met = open_ & places.get(w, 0)
        open_ = ((open_ + met) | (open_ - met)) & whole
    return len(template) - open_.bit_count()


def reported(words, name):
    tool = licenses.Scanner(licenses.TEMPLATES, 0.8)
    hits = np.flatnonzero(np.isin(words, tool.keys))
    return [x[1:] for x in tool.find(words, hits) if tool.names[x[0]] == name]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("replaced", (0, 5, 10, 15, 25, 40))
def test_decisions_equal_a_plain_search(name, replaced):
    template = hashes_of([licenses.TEMPLATES[name]])[0].tolist()
    size, said = len(template), licenses.TEMPLATES[name].split()
    for seed in range(4):
        r = random.Random(100 * replaced + seed)
        edited = [f"odd{r.randrange(1000)}" if r.randrange(100) < replaced else w for w in said]
        words = hashes_of([" ".join([prose(seed, r.randrange(60)), *edited, prose(seed + 50, r.randrange(60))])])[0]
        plain = words.tolist()
        best = max(common(plain[s:s + size], template) for s in range(max(len(plain) - size, 0) + 1)) / size
        got = reported(words, name)
        if abs(best - 0.8) > 0.03:  # next to the threshold the recursive alignment may see less than the longest subsequence
            assert bool(got) == (best > 0.8), (best, got)
        for coverage, aligned, first, last in got:
            most = common(plain[first:last + 1], template)
            assert 0.8 <= coverage <= most / size + 1e-9 and aligned <= most
            assert plain[first] in template and plain[last] in template
