import pytest

from corpusmill.llm import scans as S


def clean_words():
    """Some 500 made-up words with their counts, some of two parts."""
    parts = [a + b for a in ("tra", "pod", "mie", "wys", "zna", "kolo", "ster", "bru", "pla", "gwi") for b in ("porcie", "sta", "nina", "rowa", "lenie", "cki", "dzia", "mowy", "kt", "zek")]
    words = {w: 3 + 7 * (k % 9) for k, w in enumerate(parts)} | {a + b: 3 + k % 20 for k, (a, b) in enumerate(zip(parts, parts[37:]))}
    return words | {f"{a}-{b}": 4 + k % 7 for k, (a, b) in enumerate(zip(parts[::2], parts[5::2]))}


MODEL = S.JoinModel(clean_words())


def test_line_pairs_are_joined_by_what_is_known_of_both_ways():
    known = {"transporcie": (9, None), "polsko-angielski": (5, None), "dydaktyczno-": (3, None), "-techniczny": (4, None), "egzarninem": (0, "egzaminem")}
    small = (True, False, False)
    assert MODEL.join([("trans", "porcie", small, known)])[0] == ("transporcie", None)
    assert MODEL.join([("polsko", "angielski", small, known)])[0] == ("polsko-angielski", None)
    assert MODEL.join([("dydaktyczno", "techniczny", small, known)])[0] == ("dydaktyczno-techniczny", None)
    assert MODEL.join([("egzar", "ninem", small, known)])[0] == ("egzarninem", "egzaminem")
    assert MODEL.join([("nowe", "słowo", small, known)])[0] == ("nowesłowo", None)
    assert MODEL.join([("pod", "kowalski", (False, False, False), {})])[0] is None  # a capital after a small letter


def test_without_clean_words_small_letters_go_on():
    model = S.JoinModel({})
    assert model.trees is None and model.join([("no", "we", (True, False, False), {})])[0] == ("nowe", None) and model.join([("no", "we", (False, False, True), {})])[0] is None


@pytest.mark.parametrize(
    ("first", "known", "word", "chars"),
    [
        ("5topnia", {"pod5topnia": (0, "podstopnia")}, "podstopnia", True), ("!dea", {"pod!dea": (0, "podidea")}, "podidea", True),
        ("Owy", {"podowy": (9, None)}, "podowy", False), ("5topnia", {}, None, False), ("5G", {"pod5g": (0, None)}, None, False), ("Ona", {}, None, False), ("Ola", {}, None, False), ("2024", {}, None, False),
    ],
)
def test_breaks_before_a_misread_character(first, known, word, chars):
    found, fixed = S.repair_texts([(f"to jest pod-\n{first}, i tak dalej", ["text", "text"], known)], MODEL)[0]
    assert found == [(1, "hyphen", word)] * bool(word) + [(2, "chars", word)] * chars
    assert fixed == (f"to jest {word}, i tak dalej" if word else f"to jest pod- {first}, i tak dalej")
