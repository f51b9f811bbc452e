import hashlib
import random

from repolume.llm.substring_dedup import WINDOW, substring_dedup


def expected(texts):
    first, found = {}, {}
    for doc_id, text in sorted(texts, key=lambda pair: pair[0]):
        words = (text or "").encode().split()
        keep = [True] * len(words)
        for at in range(len(words) - WINDOW + 1):
            if first.setdefault(tuple(words[at : at + WINDOW]), doc_id) < doc_id:
                keep[at : at + WINDOW] = [False] * WINDOW
        kept = [word for word, stays in zip(words, keep, strict=True) if stays]
        found[doc_id] = (len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return found


def corpus():
    draw = random.Random(11)
    word = lambda n=5000: f"w{draw.randrange(n)}"
    some = lambda n: [word() for _ in range(n)]
    passages = [some(n) for n in (49, 50, 51, 60, 200)]
    loop = [f"l{i % 7}" for i in range(120)]
    texts = []
    for i in range(120):
        words = some(draw.randint(0, 90))
        for _ in range(draw.randint(0, 3)):
            passage = draw.choice(passages)
            cut = draw.randint(0, 12)
            words += passage[cut : len(passage) - draw.randint(0, 8)] + some(draw.randint(0, 30))
        if i % 9 == 0:
            words += loop[: draw.randint(40, 120)] + some(5) + loop[:70]  # repeats inside a text, and across texts
        texts.append(" ".join(words) if i % 5 else " \n".join(words))
    texts += [texts[3], texts[4], texts[3] + " more words", None, "", " ", " ".join(some(30_000))]
    return list(enumerate(texts))


def test_removed_words_are_those_of_all_windows(documents):
    texts = corpus()
    draw = random.Random(5)
    shuffled = draw.sample(texts, len(texts))
    found = {row["doc_id"]: tuple(row)[1:] for row in substring_dedup(documents(*shuffled)).collect()}
    assert found == expected(texts)
    assert sum(row[1] for row in found.values()) > 1000


def test_repeated_rows_null_ids_and_no_documents(documents):
    long = " ".join(f"w{i}" for i in range(60))
    docs = documents((1, long), (1, long), (None, long), (2, long), (2, "short"), (3, "x"))
    found = sorted((str(row["doc_id"]), row["n_words"], row["n_removed"]) for row in substring_dedup(docs).collect())
    assert found == [("1", 60, 0), ("1", 60, 0), ("2", 1, 0), ("2", 60, 60), ("3", 1, 0), ("None", 60, 0)]
    assert substring_dedup(docs.where("false")).count() == 0
