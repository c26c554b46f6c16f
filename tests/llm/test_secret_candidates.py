from shoplens.llm import secret_grammar as sg


def test_all_runs_are_scored():
    """Short and dotted runs, and what stands beside a base span; the score itself is left out."""
    formats = sg.Formats([], [])
    formats.bound, formats.score = 0.5, lambda value: 1.0
    text = f"see A1b2C3 or kE9.sEc7 and Kq7Zt1_{'f' * 24}_Xw8Pn2 but ordinary words or a1b2 stay"
    found = formats.spans(text, sg.base_spans(text))
    assert [v for *_, v in found] == ["A1b2C3", "kE9.sEc7", "Kq7Zt1_", "_Xw8Pn2"]
    assert all(text[s:e] == v for s, _, e, v in found)
