import random

import public_tokenizers
import sentencepiece

from silverlode.llm import token_counts as tc

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "don't  'tis ▁x ▁▁y", " ", None, "", "   a", "a   ", "\n\n a", "\t\t  \t", "日本語 テスト",
    "a\x00b ｆ ﬁ <s> </s> <unk> <0x0A>", "naïvé é", "x" * 3000, " " * 50, "😀😀 ok",
    "#include <stdio.h>\n  int main() {\n\treturn 0;\n}", "e.g. U.S.A. 3.14 1,000", " a b",
]


def texts():
    draw = random.Random(8)
    signs = "abcdeEé.,-  \n\t01日" * 2 + "▁😀"
    return ODD + ["".join(draw.choice(signs) for _ in range(draw.randrange(120)))
                  for _ in range(150)]


def test_counts_are_the_librarys(spark, documents, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    values = texts() + ["again and again"] * 5
    expected = sorted(
        (k, len((t or "").encode()), len(library.encode(t or "")),
         len(library.encode(t or "")) > 20) for k, t in enumerate(values)
    )
    # With and without pre-tokens that travel to every task.
    for common in (1 << 17, 0):
        monkeypatch.setattr(tc, "COMMON", common)
        found = tc.token_counts(spark, documents(values), PATH, limit=20).select(
            "doc_id", "n_bytes", "n_tokens", "over_limit"
        )
        assert sorted(tuple(r) for r in found.collect()) == expected


def test_frequencies_leave_tasks_in_parts(spark, documents, monkeypatch):
    monkeypatch.setattr(tc, "COLLECTED", 3)
    counts = tc._count_distinct(documents(texts()).coalesce(1), "text", PATH)
    assert counts.count() == counts.select("pretoken").distinct().count()
