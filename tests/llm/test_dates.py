"""Pseudonyms of dates in their common forms, and the inverse."""

import re

import pytest

from lorebase.llm import pii

FORMS = [
    "2021-03-25T10:00", "2021-03-25T10:00:00.5Z", "2021-03-25t10:00", "2021-03-25Z", "2021/3/5", "2021-3-25", "2021-12-5", "03/25/2021", "12/31/1999", "3/25/2021",
    "3/5/2021", "1.2.2021", "31.1.2021", "1.12.2021", "25/03/2021", "03.25.2021", "29/2/2020", "1/2/1899", "0099-12-31", "9999-01-01", "01/02.2021",
]
OTHERS = ["2021-02-30", "13/13/2021", "02/30/2021", "31/04/2021", "2021-03-25Tx", "2021-13-1", "0/1/2021"]


@pytest.mark.parametrize("form", FORMS)
def test_forms(form):
    text = f"On {form}, and ({form})."
    out, counts = pii.replace(text, "k")
    assert counts[pii.KINDS.index("date")] == 2 and sum(counts) == 2
    value = re.match("[0-9]+[/.-][0-9]+[/.-][0-9]+", form)[0]
    assert value not in out and re.sub("[0-9]", "9", out) == re.sub("[0-9]", "9", text)
    assert out.count(pii.pseudonym("date", value, "k") + form[len(value) :]) == 2
    assert pii.replace(out, "k", back=True) == (text, counts)


@pytest.mark.parametrize("text", OTHERS)
def test_not_dates(text):
    assert pii.replace(text, "k") == (text, [0] * len(pii.KINDS))


def test_each_form_is_permuted():
    for form in ("{d}/{m}/2000", "{m:02d}/{d:02d}/2000", "{d:02d}.{m}.2000", "2000-{m}-{d}"):
        values = {form.format(m=m, d=d) for m in range(1, 13) for d in range(1, 29)}
        out = {v: pii.pseudonym("date", v, "k") for v in values}
        assert len(set(out.values())) == len(values)
        assert all(pii.pseudonym("date", o, "k", back=True) == v and list(map(len, re.split("[/.-]", o))) == list(map(len, re.split("[/.-]", v))) for v, o in out.items())


def test_padded_dates_keep_their_pseudonyms():
    assert pii.pseudonym("date", "2020-02-29", "k").replace("-", "/") == pii.pseudonym("date", "2020/02/29", "k")
    d = pii.pseudonym("date", "2020-02-29", "k").split("-")
    assert pii.pseudonym("date", "29/02/2020", "k") == "/".join(d[::-1])
