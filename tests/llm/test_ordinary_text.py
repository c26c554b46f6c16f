import re
from collections import Counter

from shoplens.llm import secret_grammar as sg


def test_pairs_of_all_texts_are_counted(make_docs):
    """Also of more than 400 documents, of those longer than 20,000 characters, and without ids."""
    texts = [f"row {i} a-b/{i * 7}" for i in range(900)] + ["Qz9 " * 9000, "é=日x", "", None]
    want = Counter()
    for text in texts:
        for word in re.findall(r"[A-Za-z0-9+/_.=-]+", text or ""):
            word = f" {word} "
            want.update(zip(word, word[1:]))
    docs = make_docs([(None, t) for t in texts])
    assert {(a, b): n for a, b, n in sg.ordinary_counts(sg.id_and_text(docs))} == want
    assert sg.learn(docs).ordinary.pairs.keys() == want.keys()
