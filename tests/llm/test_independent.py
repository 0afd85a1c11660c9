"""Personal values and languages of pages against their definitions in plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from datetime import date, datetime, timedelta
from urllib.parse import urlsplit

import pytest

from marlstone.llm.language_id import identify
from marlstone.llm.pii import pseudonymise


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban(value: str) -> bool:
    plain = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def day(value: str) -> date | None:
    for form in ("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y"):
        try:
            return datetime.strptime(value, form).date()
        except ValueError:
            pass
    return None


def ssn(value: str) -> bool:
    area, group, serial = value.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


VALID = {"card": lambda v: luhn(re.sub("[^0-9]", "", v)), "iban": iban, "date": day, "ssn": ssn,
         "ipv4": lambda v: all(int(x) < 256 for x in v.split("."))}


def candidates(rng: random.Random):
    """Kind and value; valid or not, as it comes."""
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    sep = rng.choice(["", " ", "-"])
    number = rng.choice("3456") + digits(15)
    yield "card", sep.join(number[i:i + 4] for i in range(0, 16, 4))
    yield "card", next(n for n in (number[:15] + str(c) for c in range(10)) if luhn(n))
    rest = digits(18)
    check = 98 - int("".join(str(int(c, 36)) for c in rest + "DE00")) % 97
    yield "iban", f"DE{check:02d}{rest}"
    yield "iban", f"DE{rng.randint(2, 98):02d}{digits(18)}"
    some = date(1905, 1, 1) + timedelta(rng.randint(0, 60_000))
    yield "date", some.strftime(rng.choice(["%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y"]))
    yield "date", f"19{digits(2)}-{rng.randint(1, 19):02d}-{rng.randint(1, 39):02d}"
    yield "ssn", f"{rng.choice(['000', '666', '900', '123', '899', digits(3)])}-{digits(2)}-{digits(4)}"
    yield "ssn", f"123-{rng.choice(['00', '45'])}-{rng.choice(['0000', '6789'])}"
    yield "ipv4", ".".join(str(rng.randint(0, 300)) for _ in range(4))


def test_values_that_validate_are_replaced_by_values_that_validate(spark):
    rng = random.Random(11)
    texts = [[*candidates(rng)] for _ in range(150)]
    texts += texts[:20]
    rows = [(k, "; ".join(v for _, v in some)) for k, some in enumerate(texts)]
    got = {r["doc_id"]: r for r in pseudonymise(
        spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    there, back, seen = {}, {}, defaultdict(int)
    for k, some in enumerate(texts):
        new = got[k]["text"].split("; ")
        assert len(new) == len(some)
        assert got[k]["n_values"] == sum(a != v for a, (_, v) in zip(new, some))
        for (kind, old), now in zip(some, new):
            good = bool(VALID[kind](old))
            seen[kind, good] += 1
            if not good:
                assert now == old, (kind, old, now)
                continue
            assert now != old and VALID[kind](now), (kind, old, now)
            if kind != "ipv4":
                assert re.sub("[0-9]", "9", now) == re.sub("[0-9]", "9", old)
            # one to one in each kind, whatever the document
            assert there.setdefault((kind, old), now) == now
            plain = day(now) if kind == "date" else re.sub("[ -]", "", now)
            same = day(old) if kind == "date" else re.sub("[ -]", "", old)
            assert back.setdefault((kind, plain), same) == same
    assert all(seen[kind, good] >= 10 for kind in VALID for good in (True, False)), seen


def test_pseudonyms_of_rows_without_an_id(spark):
    rows = [(None, "card 4111111111111111"), (None, None), (None, ""), (1, "card 4111111111111111")]
    got = pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    texts = [r["text"] for r in got]
    assert len(got) == 4 and texts.count(None) == 1 and texts.count("") == 1
    assert len({t for t in texts if t}) == 1 and sum(r["n_values"] for r in got) == 2


def cell(three: bytes) -> int:
    return (int.from_bytes(three, "big") * 0x9E3779B1 & 0xFFFFFFFF) >> 17


def softmax(logs: list[float]) -> list[float]:
    top = max(logs)
    parts = [math.exp(x - top) for x in logs]
    return [p / sum(parts) for p in parts]


def posterior(pages, docs, weight=10.0, tempered=40.0):
    """(text posterior, posterior) of each page (url, declared, text)."""
    langs = sorted({lang for lang, _ in docs})
    counts = {x: defaultdict(float) for x in langs}
    for lang, text in docs:
        b = text.lower().encode()
        for i in range(len(b) - 2):
            counts[lang][cell(b[i:i + 3])] += 1
    total = {x: sum(counts[x].values()) + 0.5 * 32768 for x in langs}
    likely = []
    for _, _, text in pages:
        b = text.lower().encode()
        cells = [cell(b[i:i + 3]) for i in range(len(b) - 2)]
        scale = min(1.0, tempered / len(cells)) if cells else 0
        likely.append([scale * sum(math.log((counts[x][c] + 0.5) / total[x]) for c in cells) for x in langs])
    soft = [softmax(x) for x in likely]
    k = len(langs)
    everyone = [sum(s[i] for s in soft) for i in range(k)]
    groups = defaultdict(lambda: ([0.0] * k, [0]))
    names = []
    for (url, declared, _), s in zip(pages, soft):
        host = urlsplit(url).hostname or ""
        own = [("declared", declared), *[(n, ".".join(host.split(".")[-n:])) for n in (1, 2)], ("host", host)]
        names.append(own)
        for g in own:
            groups[g][1][0] += 1
            for i in range(k):
                groups[g][0][i] += s[i]
    out = []
    for own, s, text in zip(names, soft, likely):
        logs = []
        for i in range(k):
            prior = (everyone[i] - s[i] + 1) / (sum(everyone) - 1 + k)
            for g in own[1:]:
                sums, (n,) = groups[g]
                prior = (max(sums[i] - s[i], 0) + weight * prior) / (n - 1 + weight)
            logs.append(math.log(prior) + math.log((groups[own[0]][0][i] + 1) / (everyone[i] + k + 1)) + text[i])
        out.append((s, softmax(logs)))
    return langs, out


@pytest.fixture(scope="module")
def site():
    """Two languages that share a syllable: a page of it alone says little, its
    host and its declaration decide."""
    rng = random.Random(4)
    kinds = {"aa": ["th", "er", "ing"], "bb": ["sch", "ei", "ing"], "cc": ["eau", "oi", "ment"]}

    def text(lang, n):
        return " ".join("".join(rng.choices(kinds[lang], k=rng.randint(1, 3))) for _ in range(n))
    docs = [(x, text(x, 40)) for x in [*kinds] * 10]
    pages = []
    for i in range(200):
        lang = rng.choice([*kinds])
        body = "" if i % 20 == 0 else "ing" if i % 5 == 0 else text(lang, rng.choice([3, 30, 400]))
        declared = rng.choice([lang, lang, lang, ""])
        pages.append((f"https://{lang}.{rng.choice(['one.org', 'two.net'])}/x?y", declared, body))
    pages += [(pages[1][0], pages[1][1], pages[1][2])]
    pages += [(f"https://{x}.one.org/", x, "ing") for x in ("aa", "bb") for _ in range(3)]
    return docs, pages


def test_language_id_equals_its_definition(spark, site):
    docs, pages = site
    langs, expected = posterior(pages, docs)
    rows = [(i, u, (f'<html lang="{d}">' if d else "<html>") + f"<p>{t}</p></html>") for i, (u, d, t) in enumerate(pages)]
    got = {r["page_id"]: r for r in identify(
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4),
        spark.createDataFrame(docs, "lang string, text string").repartition(3)).collect()}
    assert len(got) == len(pages)
    overturned = 0
    for i, (alone, post) in enumerate(expected):
        r = got[i]
        assert abs(r["probability"] - max(post)) < 1e-3, (i, r, post)
        first, second = sorted(post, reverse=True)[:2]
        if first - second > 1e-2:
            assert r["lang"] == langs[post.index(first)]
        first, second = sorted(alone, reverse=True)[:2]
        if first - second > 1e-2:
            assert r["text_lang"] == langs[alone.index(first)]
            overturned += r["lang"] != r["text_lang"] and r["lang"] == urlsplit(pages[i][0]).hostname[:2]
    assert overturned >= 5


def test_language_id_ties_and_long_pages(spark):
    docs = spark.createDataFrame([("aa", "one two"), ("bb", "one two")], "lang string, text string")
    pages = spark.createDataFrame([(1, None, "<p>one two</p>"), (2, None, "<p>" + "one two " * 100_000 + "</p>")],
                                  "page_id long, url string, html string")
    for r in identify(pages, docs).collect():  # equal evidence: the first name
        assert r["lang"] == r["text_lang"] == "aa" and abs(r["probability"] - 0.5) < 1e-6
