"""Operators on one text at a time: pieces, blocks, pseudonyms, licences."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs, empty_docs, hard_docs, prose
from pyspark.sql import functions as F

from daybook.llm import html_text, licenses, pii
from daybook.llm.queries import TEST_KEY
from daybook.llm import sentencepiece_sampling as sp


def rows_by_text(df):
    return {r.text: r for r in df.collect()}


# --- SentencePiece -----------------------------------------------------------------------

def test_pieces_decode_to_the_text(spark):
    out = sp.decode(sp.encode(hard_docs(spark))).collect()
    assert all(r.decoded == r.text for r in out) and len(out) == 9
    assert [r.piece_ids for r in out if r.text is None] == [None]
    assert [r.piece_ids for r in out if r.text == ""] == [[]]
    assert sp.encode_decode(empty_docs(spark)).count() == 0


def test_pieces_depend_on_key_and_text_alone(spark):
    many = docs(spark, [prose(60, i % 3) for i in range(30)])
    def ids(df):
        return {r.doc_id: r.piece_ids for r in sp.encode(df).collect()}

    one = ids(many)
    assert one == ids(many.repartition(7)) == {r.doc_id: r.piece_ids for r in sp.encode_decode(many.coalesce(1)).collect()}
    assert one[0] != one[3]      # the same text under another key
    again = docs(spark, [prose(60, 0)] * 2).withColumn("doc_id", F.lit(1).cast("long"))
    first, second = (r.piece_ids for r in sp.encode(again).collect())
    assert first == second


def test_pieces_are_drawn_with_their_probability():
    vocab = sp.vocabulary(sp.MODEL, 1.0)
    pieces = {vocab.texts[i].as_py(): i for i in range(len(vocab.texts)) if vocab.end.max() and len(vocab.texts[i].as_py()) > 0}
    paths: dict[tuple, float] = {}

    def walk(rest: bytes, taken: list, weight: float) -> None:
        if not rest:
            paths[tuple(taken)] = weight
        for j in range(1, len(rest) + 1):
            i = pieces.get(rest[:j])
            if i is not None and i not in vocab.byte_id:
                walk(rest[j:], [*taken, i], weight + vocab.log_weight[i])

    walk(b" lattice", [], 0.0)
    n = 20_000
    drawn = Counter(map(tuple, sp.encode_batch(pa.array(["lattice"] * n), np.arange(n) * 977, sp.MODEL, 1.0, 3).to_pylist()))
    total = sum(np.exp(w) for w in paths.values())
    assert set(drawn) <= set(paths)
    for path, weight in paths.items():
        p = np.exp(weight) / total
        assert abs(drawn[path] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-3


def test_decoder_agrees_with_the_library():
    import sentencepiece

    known = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)
    text = "Two words,\nand 3 more: déjà vu ✓"
    ids = sp.encode_batch(pa.array([text]), np.array([5]), sp.MODEL, 0.3, 1).to_pylist()[0]
    assert known.decode(ids) == text


# --- HTML ---------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{{}}</style></head><body>
<header><a href="/">Home</a> Site name</header><nav><ul><li><a href="/a">A</a></ul></nav>
<div class="cookie-notice">We use cookies on this page and in all of its parts.</div>
<div id="content" class="wrapper has-sidebar"><article><h1>Title &amp; more</h1>
<p>First   paragraph&nbsp;with <b>bold</b> and a
line break.<p>Short.<br>Next</p><script>var x = "</p>";</script><!-- no -->
<aside class="sidebar">Not this either</aside><form><input> Send it</form>
<section class="reader-comments"><div class="comment">I was here first and it was good.</div></section></article></div>
<div class="ad">Buy this now, it is the best of all the things.</div><footer>&copy; us</footer></body></html>"""


def test_article_text(spark):
    assert html_text.main_text(PAGE) == "Title & more\n\nFirst paragraph with bold and a line break.\n\nShort. Next"


def test_blocks_without_an_article_element():
    good = "This is the text of the story and it goes on for a while so that the block is long enough to be told from a menu. " * 2
    page = (f"<html><body><div><a href='/'>one</a> | <a href='/2'>two</a></div><div>{good}</div><div>Short line</div><div>{good}</div>"
            "<div>zzz qqq xxx yyy www vvv uuu ttt sss rrr ppp ooo nnn mmm lll kkk jjj hhh ggg fff ddd bbb</div>"
            "<div>Menu</div></body></html>")
    assert html_text.main_text(page).split("\n\n") == [good.strip(), "Short line", good.strip()]


def test_text_outside_the_usual_markup():
    good = "This is the text of the story and it goes on for a while so that the block is long enough to be told from a menu. " * 2
    assert html_text.main_text(f"<body><div class='content with-sidebar'><p>{good}</p></div><div class='sidebar'>And more of it is here.</div>") \
        == good.strip()
    cards = "".join(f"<article><h3>Card {i}</h3><p>Read this too</p></article>" for i in range(3))
    assert good.strip() in html_text.main_text(f"<body><div><p>{good}</p><p>{good}</p></div>{cards}")
    polish = "Wczoraj wieczorem mieszkańcy miasta zebrali się przed ratuszem, żeby posłuchać koncertu orkiestry. " * 3
    assert html_text.main_text(f"<body><div>{polish}</div><div><a href='/'>{polish}</a></div>") == polish.strip()


SHORT_ARTICLES = [
    ("<nav><a>m</a></nav><div><a>Home</a></div><article><p>The rain stopped at noon.</p><p>Then the sun came out.</p></article>",
     ["The rain stopped at noon.", "Then the sun came out."]),
    ("<div><a>Home</a></div><main><h1><a href='#'>Title</a></h1><p>One line.</p><p><a href='/x'>A linked line.</a></p><p>Last.</p></main>",
     ["Title", "One line.", "A linked line.", "Last."]),
    ("<article><p>Rain.</p><table><tr><td>a 1</td><td>b 2</td></tr></table><pre>x = 1\ny = 2</pre></article><ul><li><a>More</a></li></ul>",
     ["Rain.", "a 1", "b 2", "x = 1 y = 2"]),
    ("<article><p>Rain.</p><ul><li><a>One</a></li><li><a>Two</a></li></ul><p>Sun.</p></article>", ["Rain.", "Sun."]),
    ("<article><p>Rain.</p><div class='share-price-table'>Shares rose by a third over the whole of the year, then fell in the last week of it.</div>"
     "<p class='search-history'>For a long time nobody had searched the archive of the town for the older papers.</p>"
     "<div class='cookie-notice'>We use cookies on this page, for the usual reasons and for some that nobody remembers.</div>"
     "<div class='share-links-x'>Share this</div><section id='comments'><p>A reader wrote a comment that is long enough to be a text of its own.</p></section></article>",
     ["Rain.", "Shares rose by a third over the whole of the year, then fell in the last week of it.",
      "For a long time nobody had searched the archive of the town for the older papers."]),
]


@pytest.mark.parametrize("page,want", SHORT_ARTICLES)
def test_articles_of_short_blocks_stay(page, want):
    assert html_text.main_text(f"<html><body>{page}</body></html>").split("\n\n") == want


def plain_two_passes(blocks):
    """The two passes stated block by block: (text, linked characters, inside) → what stays."""
    def first(k, side):
        text, linked, inside = side[k]
        if inside:
            dense = [b[1] > html_text.LINK_SHARE * len(b[0]) for b in side]
            if not dense[k]:
                return "good"
            return "bad" if len(text) >= html_text.SHORT or any(dense[j] for j in (k - 1, k + 1) if 0 <= j < len(side)) else "short"
        if linked > html_text.LINK_SHARE * len(text):
            return "bad"
        if len(text) < html_text.SHORT:
            return "short"
        words = re.findall(r"[^\W\d_]+", text.lower())
        share = sum(w in html_text.STOP_WORDS for w in words) / len(words)
        if share >= html_text.MANY_STOPS or share >= html_text.FEW_STOPS and len(text) >= html_text.LONG:
            return "good"
        return "short" if share >= html_text.FEW_STOPS else "bad"

    kept = []
    for inside in (True, False):
        side = [b for b in blocks if b[2] == inside]
        labels = [first(k, side) for k in range(len(side))]
        for k, label in enumerate(labels):
            if label == "short":
                near = sorted((abs(j - k), other != "good") for j, other in enumerate(labels) if other != "short")
                sides = [next(((abs(j - k), labels[j] != "good") for j in way if labels[j] != "short"), None)
                         for way in (range(k - 1, -1, -1), range(k + 1, len(side)))]
                found = [s for s in sides if s]
                label = "bad" if near and min(found)[1] else "good"
            if label == "good":
                kept.append(side[k])
    inside = [b for b in kept if b[2]]
    size = [sum(len(b[0]) for b in kept if b[2] == x) for x in (True, False)]
    chosen = inside if size[0] and size[0] >= size[1] else kept
    return [b[0] for b in blocks if b in chosen]


def test_two_passes_on_generated_pages():
    rng = np.random.default_rng(12)
    stops = "the and of to in is that it was for on with".split()
    for _ in range(400):
        blocks = []
        for n in range(rng.integers(1, 12)):
            words = [stops[rng.integers(len(stops))] if rng.random() < rng.choice([0, 0.2, 0.5]) else f"word{'abcdefgh'[rng.integers(8)]}"
                     for _ in range(rng.choice([2, 6, 14, 60]))]
            text = " ".join([f"b{'abcdefghijklmnop'[n]}", *words])
            blocks.append((text, len(text) if rng.random() < 0.3 else 0, bool(rng.random() < 0.5)))
        page = "".join(("<article>" if b[2] else "") + "<p>" + (f"<a href='/'>{b[0]}</a>" if b[1] else b[0]) + "</p>" + ("</article>" if b[2] else "")
                       for b in blocks)
        outside = [b for b in blocks if not b[2]]
        if html_text._listed([(b[0], b[1], b[2], False) for b in outside]):
            got = html_text.main_text(f"<body>{page}</body>")
            assert [t for t in got.split("\n\n") if t] == plain_two_passes(blocks)


def test_page_cases(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    rows = [(1, "u", PAGE, 1, "x"), (2, None, None, 2, None), (3, "u", "", None, "y"), (3, "u", "", None, "y"),
            (None, "u", "<p>" + "long text of the page and more. " * 20_000, 5, "z"), (4, "u", "a < b & c &#x41;", 6, "")]
    out = html_text.extract(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 6 and out[0].__fields__ == ["page_id", "url", "html", "text", "n_chars"]
    texts = {r.page_id: r for r in out}
    assert texts[2].text == texts[3].text == "" and texts[4].text == "a < b & c A"
    assert texts[None].n_chars == len(("long text of the page and more. " * 20_000).strip())
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0


# --- pseudonyms -----------------------------------------------------------------------------

def luhn(number: str) -> bool:
    digits = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def feistel(a, b, size_a, size_b, key, tag):
    """The permutation written out in Python."""
    for i in range(1, pii.ROUNDS + 1):
        drawn = int(hashlib.sha256(f"{key}:{tag}:{i}:{b if i % 2 else a}".encode()).hexdigest()[:15], 16)
        if i % 2:
            a = (a + drawn) % size_a
        else:
            b = (b + drawn) % size_b
    return a, b


def digits_permuted(d, kind, key=TEST_KEY):
    u = len(d) // 2
    a, b = feistel(int(d[:u]), int(d[u:]), 10**u, 10**(len(d) - u), key, f"{kind}{len(d)}")
    return f"{a:0{u}d}{b:0{len(d) - u}d}"


def one(spark, text, **more):
    return pii.pseudonymise(docs(spark, [text]), TEST_KEY, **more).first()


def test_card_numbers(spark):
    got = one(spark, "pay 4111 1111-1111 1111, 4111111111111111 and 4111111111111112.")
    spaced, plain, kept = re.findall(r"[0-9][0-9 -]{14,}[0-9]", got.text)
    payload = digits_permuted("411111111111111", "card")
    check = next(c for c in "0123456789" if luhn(payload + c))
    assert plain == payload + check and luhn(plain) and kept == "4111111111111112"
    assert re.sub(r"\D", "", spaced) == plain and re.sub(r"\d", "9", spaced) == "9999 9999-9999 9999"
    assert got.n_pseudonyms == 2


def test_addresses_phones_and_others(spark):
    text = ("10.1.2.3 300.1.1.1 v1.2.3 +1 (017) 555-7713 (017) 555-7713 078-05-1120 666-05-1120 "
            'Jo.Doe@mail.example.com jo.doe@MAIL.example.com token = "1BEB58B8AF68854F0E01B4AD40CDBB6AE7F578AE"')
    got = one(spark, text).text
    a, b = feistel(10 * 256 + 1, 2 * 256 + 3, 65536, 65536, TEST_KEY, "ipv4")
    phone = digits_permuted("0175557713", "phone")
    shape = f"({phone[:3]}) {phone[3:6]}-{phone[6:]}"
    parts = got.split(" ")
    assert parts[0] == f"{a // 256}.{a % 256}.{b // 256}.{b % 256}" and parts[1:3] == ["300.1.1.1", "v1.2.3"]
    assert f"+1 {shape} {shape} " in got and "666-05-1120" in got and "078-05-1120" not in got
    mails = re.findall(r"user-\w{12}@\w{8}\.invalid", got)
    assert len(mails) == 2 and len(set(mails)) == 1
    assert re.search(r'token = "[0-9A-F]{40}"$', got) and "1BEB58" not in got


def test_dates_stay_dates(spark):
    text = "1985-02-28 1985-02-30 28.02.1985 2/28/1985 1/2/2003 2150-01-01"
    parts = one(spark, text).text.split(" ")
    import datetime as dt

    day = dt.date.fromisoformat(parts[0])
    n = (dt.date(1985, 2, 28) - dt.date(1900, 1, 1)).days
    a, b = feistel(n // 4297, n % 4297, 17, 4297, TEST_KEY, "date")
    assert day == dt.date(1900, 1, 1) + dt.timedelta(a * 4297 + b)
    assert parts[1] == "1985-02-30" and parts[5] == "2150-01-01"
    assert parts[2] == day.strftime("%d.%m.%Y") and parts[3] == f"{day.month}/{day.day}/{day.year}"


@pytest.mark.parametrize("size_a,size_b", [(17, 4297), (10, 10), (898, 7)])
def test_the_network_is_a_permutation(size_a, size_b):
    images = {feistel(a, b, size_a, size_b, "k", "t") for a in range(size_a) for b in range(size_b)}
    assert len(images) == size_a * size_b and all(a < size_a and b < size_b for a, b in images)


def test_equal_values_stay_linked_and_keys_differ(spark):
    df = docs(spark, ["a 4111111111111111", "b 4111111111111111", "c 5500000000000004"])
    found = [re.search(r"\d{16}", r.text)[0] for r in pii.pseudonymise(df, TEST_KEY).orderBy("doc_id").collect()]
    assert found[0] == found[1] != found[2]
    other = [re.search(r"\d{16}", r.text)[0] for r in pii.pseudonymise(df, key="another").orderBy("doc_id").collect()]
    assert other[0] == other[1] != found[0]


def test_pseudonym_cases(spark):
    hard = hard_docs(spark).withColumn("n_pseudonyms", F.lit("old"))
    out = pii.pseudonymise(hard, TEST_KEY).collect()
    assert sorted(map(str, (r.text for r in out))) == sorted(map(str, (r.text for r in hard.collect())))
    assert all(r.n_pseudonyms == 0 for r in out)
    assert pii.pseudonymise(empty_docs(spark), TEST_KEY).count() == 0
    plan = pii.pseudonymise(hard, TEST_KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- licences --------------------------------------------------------------------------------

def scanned(spark, *texts):
    return [r.licenses for r in licenses.scan(docs(spark, list(texts))).orderBy("doc_id").collect()]


def test_sentences_and_rules(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
           "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
           "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
           "the Software is furnished to do so, subject to the following conditions:\nCopyright (c) 2020 Someone.\n"
           "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.")
    got = scanned(spark, "Text. Licensed under the Apache License, Version 2.0.\nMore", "RELEASED UNDER THE MIT LICENSE", mit,
                  "released under the mit license, they say", "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.",
                  mit.split("\n")[2] + "\n" + mit.split("\n")[0], "no licence here")
    assert got == [["Apache-2.0"], ["MIT"], ["MIT"], [], ["CC-BY-NC-4.0", "MIT"], [], []]


APACHE = """Copyright 2020 Someone

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""


def test_wrapped_headers(spark):
    def rows(*texts):
        return [(r.sentence_ids, r.licenses) for r in licenses.scan(docs(spark, list(texts))).orderBy("doc_id").collect()]

    apache = "<apache-2-notice><apache-2-comply><apache-2-obtain><apache-2-disclaim><apache-2-see>"
    gpl = "<gpl-free><gpl-{0}-redistribute><gpl-hope>"
    commented = "/*\n" + "".join(f" * {line}".rstrip() + "\n" for line in APACHE.split("\n")) + " */\nint x;"
    narrow = APACHE.replace('(the "License");\n   you', '(the\n   "License"); you').replace("\n", "\r\n")
    got = rows(APACHE, commented, narrow, MIT, GPL, GPL.replace("software:", "software;").replace("version 3", "version 2"), ISC, BSD, MPL)
    assert got == [(apache, ["Apache-2.0"]), (apache, ["Apache-2.0"]), (apache, ["Apache-2.0"]),
                   ("<mit-grant><mit-include><mit-warranty>", ["MIT"]), (gpl.format(3), ["GPL-3.0-or-later"]),
                   (gpl.format(2), ["GPL-2.0-or-later"]), ("<isc-grant>", ["ISC"]), ("<bsd-redistribution>", ["BSD"]),
                   ("<mpl-2-form>", ["MPL-2.0"])]
    # Lines stand for themselves first; blank lines and sentence ends still cut; a run is a whole sentence.
    got = rows("This work is\nLicensed under the GNU General Public License, version 3.", "Licensed under the\n\nMIT License",
               "Licensed under the MIT.\nLicense", "Not licensed under the\nMIT License", "Licensed under the\nMIT License, they say",
               "# Licensed under\n# the MIT\n# License\n", "unencumbered\nThis is free and unencumbered software released into the public\ndomain.",
               "\x01 Released under the MIT License.\n\x02")
    assert [g[0] for g in got] == ["<gpl-3-licensed>", "", "", "", "", "<mit-licensed>", "<unlicense>", "<mit-released>"]


def test_tables_fit_together():
    names = {i for _, ids in licenses.RULES for i in ids}
    assert names <= set(licenses.SENTENCES)
    assert [len(ids) for _, ids in licenses.RULES] == sorted((len(ids) for _, ids in licenses.RULES), reverse=True)
    assert all(re.search(licenses.ANCHOR, s) for s in licenses.SENTENCES.values())


def test_license_cases(spark):
    hard = hard_docs(spark).withColumn("licenses", F.lit(1))
    out = licenses.scan(hard).collect()
    assert len(out) == 9 and all(r.licenses == [] and r.n_licensed_sentences == 0 for r in out)
    assert licenses.scan(empty_docs(spark)).count() == 0
    plan = licenses.scan(hard)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- pseudonyms: spellings, kinds, columns ---------------------------------------------------------


def pseudonyms(spark, texts, **more):
    return [r.text for r in pii.pseudonymise(docs(spark, texts), TEST_KEY, **more).orderBy("doc_id").collect()]


def test_spellings_of_a_number_link(spark):
    groups = [["+447700900123", "+44 7700 900123", "+44 7700 900 123", "+44-7700-900-123", "+44 (7700) 900123"],
              ["+12125550100", "+1 212 555 0100", "(212) 555-0100", "212-555-0100", "+1 (212) 555-0100"],
              ["GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432"], ["4111 1111 1111 1111", "4111111111111111"],
              ["2001:db8:0:0:0:0:0:1", "2001:0DB8:0000:0000:0000:0000:0000:0001"]]
    flat = [f"call {t} now" for g in groups for t in g]
    new = pseudonyms(spark, flat)
    at = 0
    for g in groups:
        mine = [n.removeprefix("call ").removesuffix(" now") for n in new[at:at + len(g)]]
        at += len(g)
        plain = {re.sub(r"[^0-9A-Za-z+:]", "", m).lower() for m in mine}
        if g[0].startswith("+1"):
            plain = {p[-10:] for p in plain}
        assert len(plain) == 1 and not plain & {re.sub(r"[^0-9A-Za-z+:]", "", t).lower()[-len(next(iter(plain))):] for t in g}
        for old, m in zip(g, mine, strict=True):
            if ":" not in old:      # separators, letters and length stay
                assert re.sub("[0-9]", "0", old) == re.sub("[0-9]", "0", m)
    assert new[0].startswith("call +44") and new[5].startswith("call +1")


def test_ibans_stay_valid(spark):
    old = ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "FR14 2004 1010 0505 0001 3M02 606", "NO9386011117947"]
    bad = ["GB83 WEST 1234 5698 7654 32", "DE00370400440532013000"]
    new = pseudonyms(spark, old + bad)
    for a, b in zip(old, new, strict=False):
        v = b.replace(" ", "")
        assert a != b and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1 and a[:2] == b[:2]
    assert new[len(old):] == bad


def test_other_kinds(spark):
    hexed = "0123456789abcdef" * 3
    texts = ["born 12 March 1984 and", "born March 3, 1984.", "on 12-03-1984", "on 3 Feb 2001", 'id = "' + hexed * 4 + '"', f"api_key={hexed}",
             "ghp_" + "a1B2" * 9, "AKIA" + "ABCD1234" * 2, "fe80:0:0:0:1:2:3:4"]
    for old, new in zip(texts, pseudonyms(spark, texts), strict=True):
        assert old != new and (len(old) == len(new) or " 1984" in old or "Feb" in old or ":" in old), (old, new)
    for text, shape in (("born 12 March 1984 and", r"born \d{1,2} [A-Z][a-z]+ (19|20)\d\d and"), ("on 12-03-1984", r"on \d\d-\d\d-(19|20)\d\d"),
                        ("AKIA" + "ABCD1234" * 2, r"AKIA[0-9A-Z]{16}"), ("fe80:0:0:0:1:2:3:4", r"([0-9a-f]{4}:){7}[0-9a-f]{4}")):
        assert re.fullmatch(shape, pseudonyms(spark, [text])[0])
    calm = ["Section 12-03-84 of 31 Smarch 2001", "a::b std::vector", "+1 2", "May 99, 2000", "KEY " + "XY12" * 3]
    assert pseudonyms(spark, calm) == calm


def test_text_columns_of_other_spellings_and_clashes(spark):
    df = docs(spark, ["mail a@b.org", "none", None]).withColumnRenamed("text", "Text").withColumn("_parts", F.lit("mine")).withColumn("_new", F.lit(1))
    out = pii.pseudonymise(df, TEST_KEY, "text").orderBy("doc_id").collect()
    assert out[0].Text.startswith("mail user-") and [r.n_pseudonyms for r in out] == [1, 0, 0] and out[2].Text is None
    assert out[0]["_parts"] == "mine" and out[0]["_new"] == 1
    with pytest.raises(ValueError):
        pii.pseudonymise(df, "", "text")


def test_texts_that_hold_the_mark(spark):
    old = f"{pii.MARK}a@b.org{pii.MARK} and 10.1.2.3"
    new = pseudonyms(spark, [old, old.replace(pii.MARK, " ")])
    assert new[0].replace(pii.MARK, " ") == new[1] and new[0].count(pii.MARK) == 2


def test_clashing_names_of_other_operators(spark):
    df = docs(spark, ["some words here"]).withColumn("_stream", F.lit("a")).withColumn("__stream", F.lit("b"))
    row = sp.encode_decode(df).first()
    assert (row["_stream"], row["__stream"], row.decoded) == ("a", "b", "some words here")


BSD_CLAUSES = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""


def test_more_licences(spark):
    cases = [("// SPDX-License-Identifier: MIT", ["MIT"]), ("# SPDX-License-Identifier: Apache-2.0\ncode", ["Apache-2.0"]),
             ("/* SPDX-License-Identifier: GPL-2.0-or-later */", ["GPL-2.0-or-later"]), ("SPDX-License-Identifier: GPL-2.0", ["GPL-2.0-only"]),
             ("SPDX-License-Identifier: Nothing-1.0", []), (BSD_CLAUSES + ENDORSE, ["BSD-3-Clause"]), (BSD_CLAUSES, ["BSD-2-Clause"]), (LGPL, ["LGPL-2.1-or-later"]),
             ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.", ["EPL-2.0"]),
             ("Licensed under the EUPL, Version 1.2", ["EUPL-1.2"]), ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
             ('Licensed under the Apache License, Version 2.0 (the "' + "Long Name Of A License " * 5 + '");\n'
              "you may not use this file except in compliance with the License.", ["Apache-2.0"])]
    out = licenses.scan(docs(spark, [t for t, _ in cases])).orderBy("doc_id").collect()
    for (text, want), row in zip(cases, out, strict=True):
        assert row.licenses == want, (text, row.sentence_ids)


def plain_sentences(text):
    """Known sentences of a text whose lines are whole: each line and each sentence of a line."""
    out = []
    for part in re.split(r"\r\n?|\n|(?<=[.!?;])(?<!\bv\.)[ \t]+", text):
        words = re.sub(r"[^\w.]|_", " ", part.lower()).split()
        norm = " ".join(words).strip(" .")
        out += [k for k, v in licenses.SENTENCES.items() if v == norm]
    return out


def test_wrapped_notices_against_brute_force(spark):
    """A notice broken anywhere at blanks, behind comment signs, has the sentences of its unwrapped form."""
    rng = np.random.default_rng(4)
    # A line that is a known sentence by itself is read so: sentences that hold another one are left out here.
    names = [k for k, v in licenses.SENTENCES.items() if not k.startswith("spdx") and len(v.split()) > 6
             and not any(w in v for w in licenses.SENTENCES.values() if w != v)]
    texts, want = [], []
    for _ in range(60):
        chosen = [names[rng.integers(len(names))] for _ in range(rng.integers(1, 4))]
        lines = []
        for name in chosen:
            words, line = (licenses.SENTENCES[name] + ".").split(), []
            for w in words:
                line.append(w)
                if rng.random() < 0.2:
                    lines.append(line)
                    line = []
            lines += [line] if line else []
            lines.append([])
        sign = rng.choice(["", "# ", " * ", "// "])
        texts.append("\n".join(sign + " ".join(x) for x in lines))
        want.append(chosen)
    out = licenses.scan(docs(spark, texts)).orderBy("doc_id").collect()
    for text, names_, row in zip(texts, want, out, strict=True):
        assert re.findall("<([^>]*)>", row.sentence_ids) == names_, text
        assert plain_sentences("\n".join(licenses.SENTENCES[n] + "." for n in names_)) == names_
