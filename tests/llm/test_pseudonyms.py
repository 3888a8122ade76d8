import calendar
import re
from datetime import date

from wayflux.llm.pseudonyms import KINDS, Feistel, Pseudonyms, _luhn, pseudonym_report, pseudonymised
from wayflux.llm.queries import op9_pseudonyms

RULE = Pseudonyms(b"a key")


def new(text, rule=RULE):
    return pseudonymised(text, rule)[0]


def test_permutation_is_one_to_one_and_can_be_undone():
    for size in (1, 2, 3, 10, 97, 1000):
        network = Feistel(b"k", "x", size)
        image = [network.forward(v) for v in range(size)]
        assert sorted(image) == list(range(size)) and [network.backward(v) for v in image] == list(range(size))
    big = Feistel(b"k", "x", 10 ** 40)
    assert big.backward(big.forward(12345)) == 12345


def test_formats_stay_valid():
    card = new("pay 4539 1488 0343 6467 now")
    assert re.fullmatch(r"pay 4\d{3} \d{4} \d{4} \d{4} now", card) and "1488" not in card
    digits = re.sub(r"\D", "", card)
    assert _luhn(digits[:-1]) == int(digits[-1])
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new("+1 (988) 555-2485"))
    assert re.fullmatch(r"[2-9]\d\d-[2-9]\d\d-\d{4}", new("988-555-2485"))
    area, group, serial = map(int, new("123-45-6789").split("-"))
    assert 0 < area < 900 and area != 666 and group and serial
    assert all(int(p) <= 255 for p in new("42.144.35.254").split("."))
    for text in ("2024-02-29", "31/12/1999", "12/31/1999", "01.02.2003"):
        parts = re.split(r"[-/.]", new(text))
        year, month, day = (parts if len(parts[0]) == 4 else (parts[2], *((parts[0], parts[1]) if text.startswith("12/31") else (parts[1], parts[0]))))
        assert int(day) <= calendar.monthrange(int(year), int(month))[1] and date(int(year), int(month), int(day))
    iban = new("GB82 WEST 1234 5698 7654 32")
    plain = iban.replace(" ", "")
    assert iban.startswith("GB") and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert re.fullmatch(r"[a-z]{5}\.\d\d@mail8\.example\.com", new("bosbt.42@mail8.example.com"))


def test_equal_values_stay_linked_whatever_their_layout():
    a, b = new("4539 1488 0343 6467"), new("4539-1488-0343-6467, 4539148803436467")
    assert {re.sub(r"\D", "", x) for x in (a, *b.split(", "))} == {re.sub(r"\D", "", a)}
    assert new("4539148803436467", Pseudonyms(b"other")) != new("4539148803436467")


def test_every_kind_is_linked_across_its_layouts():
    digits = lambda s: re.sub(r"\D", "", s)
    layouts = {
        "telephone": ["988-555-2485", "(988) 555-2485", "+1 988-555-2485", "988.555.2485", "+1 (988) 555 2485", "1-988-555-2485"],
        "other": ["(088) 155-2485", "+1 088-155-2485", "(088)155-2485"],
        "card": ["4539 1488 0343 6467", "4539-1488-0343-6467", "4539148803436467"],
        "account": ["GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432", "gb82west12345698765432", "gb82 west 1234 5698 7654 32"]}
    for kind, values in layouts.items():
        made = {re.sub(r"[^0-9a-z]", "", new(v).lower())[-10 if kind in ("telephone", "other") else None:] for v in values}
        old = {re.sub(r"[^0-9a-z]", "", v.lower())[-10 if kind in ("telephone", "other") else None:] for v in values}
        assert len(made) == len(old) == 1 and made != old, (kind, made)
    for v in layouts["telephone"]:
        number = digits(new(v))[-10:]
        assert number[0] not in "01" and number[3] not in "01" and len(new(v)) == len(v)
    dates = ["2024-01-02", "2024/01/02", "2024.01.02", "02/01/2024", "02.01.2024"]
    parts = [re.split(r"[-/.]", new(d)) for d in dates]
    assert len({tuple(p if len(p[0]) == 4 else p[::-1]) for p in parts}) == 1
    assert new("2024-01-02T10:00:00Z") == new("2024-01-02") + "T10:00:00Z" != "2024-01-02T10:00:00Z"
    assert new("2024-01-02Test") == "2024-01-02Test"


def number_of(kind, value):
    """(kind of permutation, size, number) of a value in its format; None where it is not valid."""
    plain = re.sub(r"[^0-9A-Za-z]", "", value)
    if kind == "card":
        total = sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(plain)))
        return ("card", 10 ** (len(plain) - 2), int(plain[1:-1])) if total % 10 == 0 and plain[0] != "0" else None
    if kind == "telephone":
        n = plain[-10:]
        plan = n[0] in "23456789" and n[3] in "23456789"
        heads = sorted(a + b for a in "0123456789" for b in "0123456789" if (a in "23456789" and b in "23456789") == plan)
        return ("telephone" if plan else "telephone-other", len(heads) * 10 ** 8, heads.index(n[0] + n[3]) * 10 ** 8 + int(n[1:3] + n[4:]))
    if kind == "security":
        areas = [a for a in range(1, 900) if a != 666]
        return "security", 898 * 99 * 9999, (areas.index(int(plain[:3])) * 99 + int(plain[3:5]) - 1) * 9999 + int(plain[5:]) - 1
    if kind == "machine":
        a, b, c, d = map(int, value.split("."))
        return ("machine", 2 ** 32, ((a * 256 + b) * 256 + c) * 256 + d) if max(a, b, c, d) < 256 else None
    if kind == "date":
        p = re.split(r"[-/.]", value)
        y, m, d = p if len(p[0]) == 4 else (p[2], p[1], p[0])
        options = [(m, d)] if int(m) <= 12 else [(d, m)]
        return "date", (date(2099, 12, 31) - date(1900, 1, 1)).days + 1, (date(int(y), int(options[0][0]), int(options[0][1])) - date(1900, 1, 1)).days
    body, name = (plain[4:], "account") if kind == "account" else (value.partition("@")[0], "mail0")
    if kind == "account" and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
        return None
    size = index = 0
    for c in body:
        n = 10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 1
        size = max(size, 1) * n
        if n > 1:
            index = index * n + int(c, 36) - (0 if n == 10 else 10)
    return name, max(size, 1), index


def test_pseudonyms_of_all_documents_are_valid_and_can_be_undone(spark, sf_dir, texts):
    key, old, seen = b"key of the test tables", dict(texts), set()
    for r in op9_pseudonyms(spark, sf_dir).collect():
        moved, shift = r.text or "", 0
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        for n, (kind, a, b) in enumerate(spans):
            value, rest = old[r.doc_id][a:b], old[r.doc_id][b:(spans + [("", 10 ** 9, 0)])[n + 1][1]]
            end = moved.index(rest, a + shift + 1) if rest else len(moved)
            made = moved[a + shift:end]
            while kind == "machine" and len(made) < 7:
                end = moved.index(rest, end + 1)
                made = moved[a + shift:end]
            if kind != "machine":
                made = moved[a + shift:b + shift]
            shift += len(made) - len(value)
            if kind == "mail" and len(value.partition("@")[0]) > 24:
                continue
            was, now = number_of(kind, value), number_of(kind, made)
            assert was and now and was[:2] == now[:2], (kind, value, made)
            assert Feistel(key, *now[:2]).backward(now[2]) == was[2], (kind, value, made)
            seen.add(kind)
    assert len(seen) >= 4, seen


def test_what_is_not_valid_stays():
    for text in ("4539148803436468", "999.1.1.1", "2023-02-30", "000-12-3456", "GB82WEST12345698765433", "no data", "v1.2.3.4.5",
                 "1234567890123456789012345", "", None):
        assert pseudonymised(text, RULE) == (text, [])


def test_all_documents(spark, sf_dir, texts):
    rows, old = op9_pseudonyms(spark, sf_dir).collect(), dict(texts)
    assert len(rows) == len(texts)
    valid, same = 0, {}
    for r in rows:
        out, spans = pseudonymised(old[r.doc_id], Pseudonyms(b"key of the test tables"))
        assert (r.text or "") == (out or "") and r.n_values == len(spans)
        assert r.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        for k, a, b in spans:
            valid += 1
            assert k in KINDS and old[r.doc_id][a:b] not in (r.text if k in ("mail", "card") else "")
        if not spans:
            assert (r.text or "") == old[r.doc_id]
        same.setdefault(old[r.doc_id], set()).add(r.text)
    assert valid > 0 and all(len(x) == 1 for x in same.values())


def test_odd_rows(spark, odd, none):
    rows = pseudonym_report(odd, RULE).collect()
    assert len(rows) == odd.count() and [r.text for r in rows if r.doc_id == 1] == [None]
    assert pseudonym_report(none, RULE).count() == 0
