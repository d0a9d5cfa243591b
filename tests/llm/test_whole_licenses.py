"""Every notice of a run of notices is found."""

import pytest
from cases import prose

from ventaria.llm import licenses
from ventaria.llm.decontam import hashes_of

LONG = ("MIT-notice", "Apache-2.0-header", "GPL-3.0-header", "BSD-3-Clause")


def found(made, name):
    import numpy as np

    tool = licenses.Scanner(licenses.TEMPLATES, 0.8)
    words = hashes_of([made])[0]
    hits = np.flatnonzero(np.isin(words, tool.keys))
    return [x[1:] for x in tool.find(words, hits) if tool.names[x[0]] == name]


@pytest.mark.parametrize("name", LONG)
@pytest.mark.parametrize("times", (2, 3, 50))
@pytest.mark.parametrize("between", (0, 1, 7, 30))
def test_repeated_notices(name, times, between):
    size = len(hashes_of([licenses.TEMPLATES[name]])[0])
    made = ("\n" + prose(9, between) + "\n").join([licenses.TEMPLATES[name]] * times) if between else "\n".join([licenses.TEMPLATES[name]] * times)
    at = [k * (size + between) for k in range(times)]
    assert found(made, name) == [(1.0, size, k, k + size - 1) for k in at]


@pytest.mark.parametrize("name", LONG)
def test_edited_neighbours(name):
    words = licenses.TEMPLATES[name].split()
    edited = words[:6] + ["really"] + words[7:20] + words[21:]
    got = found("\n".join([" ".join(edited), " ".join(words), " ".join(edited)]), name)
    assert len(got) == 3 and got[1][0] == 1.0 and all(x[0] >= 0.9 for x in got)
    assert all(x[3] < y[2] for x, y in zip(got, got[1:]))


def test_a_stray_word_does_not_hide_the_notice():
    words = licenses.TEMPLATES["Apache-2.0-header"].split()
    made = "Licensed " + prose(4, 8) + " " + " ".join(words[1:]) + " " + prose(5, 20)
    assert [x[0] >= 0.9 for x in found(made, "Apache-2.0-header")] == [True]
    assert licenses.closest([(0, 0), (50, 1), (51, 2), (52, 3)], 10) == [(50, 1), (51, 2), (52, 3)]
