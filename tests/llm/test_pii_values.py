"""Pseudonyms that stay linked, stay valid, and long texts in linear time."""

import random
import time

from lorebase.llm import pii


def test_security_numbers_invert():
    r = random.Random(2)
    for _ in range(2000):
        v = f"{r.choice([*range(1, 666), *range(667, 900)]):03d}-{r.randint(1, 99):02d}-{r.randint(1, 9999):04d}"
        out = pii.pseudonym("ssn", v, "k")
        assert pii._valid_ssn(out) and pii.pseudonym("ssn", out, "k", back=True) == v


def test_one_number_in_several_forms():
    forms = ("+1-976-555-9947", "+1 976 555 9947", "976-555-9947", "(976) 555-9947", "+1 (976) 555-9947")
    found = [pii.replace(f"call {f} now", "k") for f in forms]
    assert all(n[pii.KINDS.index("phone")] == 1 for _, n in found)
    digits = {"".join(c for c in out if c.isdigit())[-10:] for out, _ in found}
    assert len(digits) == 1 and digits != {"9765559947"}
    assert found[0][0].startswith("call +1-") and found[1][0].startswith("call +1 ")
    assert [pii.replace(out, "k", back=True)[0] for out, _ in found] == [f"call {f} now" for f in forms]


def test_keys_differ_and_may_be_long():
    assert pii.pseudonym("ssn", "123-45-6789", "a") != pii.pseudonym("ssn", "123-45-6789", "b" * 500)


def test_long_texts():
    began = time.time()
    for text in ("a" * 1_000_000 + " 1", "a1." * 300_000, "a@" * 300_000, "1" * 500_000, "a@b." * 200_000, "AB12 " * 100_000):
        pii.replace(text, "k")
    assert pii.replace("x" * 500_000 + "@mail.example.com x@mail.example.com", "k")[1][0] == 1
    assert time.time() - began < 60
