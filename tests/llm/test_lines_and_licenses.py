import random
import textwrap
from collections import defaultdict

from silverlode.llm import license_scan as ls
from silverlode.llm import line_dedup as ld
from silverlode.llm.license_templates import TEMPLATES, TEXTS


def brute(rows, ratio, least, copies_once=False):
    pages, times = defaultdict(int), defaultdict(int)
    counted = [(None, *page) for page in {row[1:] for row in rows}] if copies_once else rows
    for _, host, text in counted:
        pages[host] += 1
        for line in set((text or "").split("\n")):
            if line.strip(" \t\n\v\f\r"):
                times[host, line] += 1
    result = []
    for name, host, text in rows:
        lines = [] if text is None else text.split("\n")
        left = [line for line in lines if not (
            times[host, line] >= least and times[host, line] > ratio * pages[host]
        )]
        result.append((name, None if text is None else "\n".join(left), len(lines),
                       len(lines) - len(left)))
    return sorted(result, key=repr)


def site_pages():
    draw = random.Random(7)
    common = {host: [f"menu {host} {k}" for k in range(4)] for host in ("a", "b", None, "c")}
    rows = []
    for k in range(260):
        host = draw.choice(["a"] * 5 + ["b", None, "c"])
        lines = [draw.choice(common[host]) for _ in range(draw.randrange(4))]
        lines += [f"text {draw.randrange(90)}", "", f"own {k}", "menu b 0", "  "]
        rows.append((k, host, "\n".join(lines)))
    return [*rows, (1, "a", None), (2, "a", ""), (3, "b", "\n"), rows[4], rows[4], (None, None, "x")]


def test_lines_like_brute_force(spark, monkeypatch):
    rows = site_pages()
    pages = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    for broadcast in (ld.BROADCAST_LINES, 0):
        monkeypatch.setattr(ld, "BROADCAST_LINES", broadcast)
        for once in (False, True):
            found = ld.drop_boilerplate(spark, pages, ratio=0.2, min_pages=4, copies_once=once)
            got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()]
            assert sorted(got, key=repr) == brute(rows, 0.2, 4, once)


def test_copies_of_a_page_may_count_once(spark):
    """Six copies on a host of 26 pages lose nothing but the host's own menu."""
    page = "A page of its own.\nIt says more.\nmenu"
    rows = [(k, "a", page) for k in range(6)] + [(k, "a", f"text {k}\nmenu") for k in range(6, 26)]
    pages = spark.createDataFrame(rows, "doc_id long, source string, text string")
    every = {r.doc_id: r.text for r in ld.drop_boilerplate(spark, pages).collect()}
    once = {r.doc_id: r.text for r in ld.drop_boilerplate(spark, pages, copies_once=True).collect()}
    assert every[0] == "" and once[0] == "A page of its own.\nIt says more."
    assert every[7] == once[7] == "text 7"


def test_long_pages_with_very_many_plates(spark):
    """Each of 3,000 lines of six pages is boilerplate, a line of each page and of others is not."""
    menu = [f"menu {k}" for k in range(3000)]
    rows = [(k, "a", "\n".join([*menu, f"own {k}"])) for k in range(6)]
    rows += [(k, "a", f"text {k}\nmenu {k}") for k in range(6, 12)] + [(12, "b", "menu 1\nb")]
    pages = spark.createDataFrame(rows, "doc_id long, source string, text string")
    plates = ld._boilerplate(pages.toDF("_id", "_host", "_text"), ld.RATIO, ld.MIN_PAGES).first()
    assert plates["_host"] == "a" and len(plates.plates) == 3000
    assert sum(map(len, plates.plates)) == 3000 and max(map(len, plates.plates)) < 20
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in ld.drop_boilerplate(spark, pages).collect()]
    assert sorted(got, key=repr) == brute(rows, ld.RATIO, ld.MIN_PAGES, False)


def test_main_path_has_no_python(spark):
    pages = spark.createDataFrame(site_pages(), "doc_id long, source string, text string")
    plan = ld.drop_boilerplate(spark, pages)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def scan(documents, texts):
    return sorted(ls.license_scan(documents(texts)).collect(), key=lambda r: (r.doc_id, r.first))


def test_notices_are_named_by_wording(documents):
    found = scan(documents, [
        "Some text.\nReleased under the MIT License.\nMore.",
        "This work is licensed under the GNU General Public License, version 2.",
        "This work is licensed under the GNU General Public License, version 3!",
        "Licensed under CC BY-SA 4.0.\nnothing\nLicensed under CC BY-NC 4.0.",
        "licensed under the apache license, version 2.0 (the \"License\")",
        "A driving licence is needed to drive a car in this country, she said.",
        "no notice here", None, "",
        "Licensed under the Apache License,\nLicensed under CC BY 4.0.",
    ])
    assert [(r.doc_id, r.license, r.verdict) for r in found][:5] == [
        (0, "MIT", "exact"), (1, "GPL-2.0", "exact"), (2, "GPL-3.0", "exact"),
        (3, "CC-BY-SA-4.0", "exact"), (3, "CC-BY-NC-4.0", "exact"),
    ]
    assert (found[5].license, found[5].verdict) == ("Apache-2.0", "changed")
    assert found[5].added == ["the", "license"] and found[5].missing == []
    assert found[6].verdict == "mention" and found[6].doc_id == 5
    assert len(found) == 8 and found[7].block.count("\n") == 1
    assert all(0 < r.reduction < 1 for r in found[:6])


def test_long_lines_are_cut_at_sentences(documents):
    text = "Plain words. " * 400 + "Released under the MIT License. " + "More of them. " * 400
    (one,) = scan(documents, [text])
    assert one.block == "Released under the MIT License." and one.verdict == "exact"
    assert text[one.first : one.end] == one.block


def test_blocks_cover_the_trigger_lines_of_any_text():
    draw = random.Random(2)
    parts = ["license x", "plain", "", "Copyright 2020.", "a. licensed b. c", "\r", "é"]
    for _ in range(200):
        text = "\n".join(draw.choice(parts) for _ in range(draw.randrange(9)))
        covered = "".join(text[a:b] for a, b in ls.blocks(text))
        for word in ("license", "Copyright"):
            assert covered.count(word) == text.count(word)


def wrapped(text, width=60, before=""):
    lines = textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False)
    return "\n".join(before + line for line in lines)


def first_text(name):
    return max((text for one, text in TEXTS if one == name), key=len)


def test_hard_wrapped_licences_are_exact(documents):
    prose = "Some words on the project come first.\n\n"
    names = ["MIT", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "Apache-2.0", "ISC"]
    for before in ("", "# ", " * "):
        found = scan(documents, [
            prose + wrapped(first_text(name), 60, before) + "\n\nAnd more words behind."
            for name in names
        ])
        assert [(r.license, r.verdict) for r in found] == [(name, "exact") for name in names]
        assert all(r.missing == [] and "words" not in r.block for r in found)


def test_blank_lines_do_not_cut_a_header(documents):
    header = first_text("Apache-2.0").replace(" http", "\n\n    http")
    header = header.replace(" Unless", "\n\nUnless")
    (one,) = scan(documents, [f"/*\n{header}\n*/"])
    assert (one.license, one.verdict) == ("Apache-2.0", "exact")


def test_first_sentences_of_wrapped_notices(documents):
    short = [text for _, text in TEMPLATES if len(text.split()) > 15]
    found = scan(documents, [
        "Prose goes here.\n" + wrapped(text, 40) + "\nIt goes on." for text in short
    ])
    assert [r.verdict for r in found] == ["exact"] * len(short)
    (changed,) = scan(documents, [wrapped(first_text("MIT").replace("merge, ", ""), 70)])
    assert (changed.license, changed.verdict, changed.missing) == ("MIT", "changed", ["merge"])


def test_a_notice_has_one_verdict_at_every_line_length(documents):
    texts = [
        "Plain words here. " * n + "Released under the MIT License. " + "More of them. " * n
        for n in (1, 10, 50, 61, 62, 63, 64, 100, 500)
    ] + ["plain words " * n + "Released under the MIT License and more " * 2 for n in (90, 900)]
    found = scan(documents, texts)
    assert [r.verdict for r in found] == ["exact"] * 13
    assert {r.block.rstrip(".") for r in found} == {"Released under the MIT License"}


def test_every_notice_of_adjoining_lines_is_reported(documents):
    listed = [(name, text) for name, text in TEMPLATES if text.endswith(".")]
    found = scan(documents, ["\n".join(text for _, text in listed), "\n".join(
        ["Released under the MIT License."] * 3)])
    assert [r.license for r in found] == [name for name, _ in listed] + ["MIT"] * 3
    assert {r.verdict for r in found} == {"exact"}
    (one,) = scan(documents, ["Licensed under the Apache License,\nLicensed under CC BY 4.0."])
    assert [(n.license, n.verdict) for n in one.notices] == [
        ("Apache-2.0", "changed"), ("CC-BY-4.0", "exact")
    ]
    assert one.notices[0].missing == ["version", "2.0"]


def test_aligned_spans_like_plain_search():
    """Every span that agrees is met by one that is found."""
    draw = random.Random(8)
    wording = "a b c d e f g h i".split()
    aligner = ls.Aligner([wording])
    for _ in range(300):
        words = []
        for _ in range(draw.randrange(1, 4)):
            part = [w for w in wording if draw.random() < .93]
            for _ in range(draw.randrange(3)):
                part.insert(draw.randrange(len(part) + 1), "x")
            words += ["y"] * draw.randrange(3) + part
        found = aligner(words, list(range(len(words))))
        met = {k for one in found for k in range(one.first, one.end)}
        for first in range(len(words)):
            for end in range(first + 1, min(first + 15, len(words) + 1)):
                if aligner.agreeing(0, words[first:end], first):
                    assert met & set(range(first, end))


def test_named_by_the_ranking_of_all_templates(documents):
    """Every row's licence, share and differences are those of a plain ranking of its block."""
    import zstandard

    everything = [*TEMPLATES, *TEXTS]
    plain = zstandard.ZstdCompressor(level=ls.LEVEL)
    texts = ["Prose first. " + text.replace(" the ", " a ", k % 3) + " More prose, no license."
             for k, (_, text) in enumerate(everything)]
    rows = scan(documents, texts)
    assert len(rows) >= len(texts)
    for row in rows:
        blocks = [(n.license, n.missing, n.added, text_of(texts, row, n)) for n in row.notices] or [
            (row.license, row.missing, row.added, row.block)]
        for license, missing, added, block in blocks:
            data = block.encode()
            ranked = sorted((len(zstandard.ZstdCompressor(
                level=ls.LEVEL, dict_data=zstandard.ZstdCompressionDict(
                    text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            ).compress(data)) - len(plain.compress(data)), place)
                for place, (_, text) in enumerate(everything))
            finalists = [(sum(map(len, ls._common(ls._words(everything[place][1]),
                                                  ls._words(block))[:2])), k, place)
                         for k, (_, place) in enumerate(ranked[: ls.FINALISTS])]
            differing, _, place = min(finalists)
            assert license == everything[place][0] and len(missing) + len(added) == differing


def text_of(texts, row, notice):
    return texts[row.doc_id][notice.first : notice.end]


def test_the_ranking_decides_not_the_alignment(documents):
    """The aligner proposes either of two templates for a block; what compresses best names it."""
    one = "This file is licensed under terms of one kind as they stand in the first book of laws."
    two = one.replace("one kind", "other sort").replace("first", "second")
    block = one.replace("one kind", "other sort")
    rows = [ls.license_scan(documents([block]), templates=[("first", a), ("last", b)], texts=[])
            .collect()[0] for a, b in ((one, two), (two, one))]
    assert [r.license for r in rows] == ["last", "first"]
    assert all(r.verdict == "changed" and (r.missing, r.added) == (["second"], ["first"])
               for r in rows)
