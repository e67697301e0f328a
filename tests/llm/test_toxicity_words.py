import pytest

from crowdpulse.llm import toxicity

TERMS = [toxicity.Term("idiot", False, 1, 3.0), toxicity.Term("moron", True, 0, 3.0), toxicity.Term("half-wit", False, 0, 3.0)]


@pytest.fixture()
def scorer():
    return toxicity.Scorer(toxicity.Model(TERMS, [0.0, 1.0, 0.0, 0.0]))


@pytest.mark.parametrize("text, names", [
    ("oh you,idiot there", ["idiot"]), ("x/idiot", ["idiot"]), ("<p>idiot</p>", ["idiot"]), ("a_idiot", ["idiot"]), ("so,idoit,idiot", ["idiot"]),
    ("such.moron/idiot", ["idiot", "moron*"]), ("moron" + "x" * 60, ["moron*"]), ("lorem,ipsum," * 20 + "idiot", ["idiot"]),
    ("a half-wit said", ["half-wit"]), ("half-wit/idiot", ["idiot"])])
def test_terms_are_seen_inside_tokens(scorer, text, names):
    assert sorted({h[1] for h in scorer.hits(text)}) == names


def test_a_token_counts_once_and_sees_its_own_address(scorer):
    assert [h[3] for h in scorer.hits("moron's")] == [3.0]
    assert scorer.hits("you,idiot")[0][3] == pytest.approx(3.6)
    assert len(scorer.hits("idiot,idiot")) == 2
    assert toxicity.parts_of("क्षि") == [] and toxicity.parts_of("a_b-éx") == ["a", "b", "éx"]


@pytest.mark.parametrize("text, spans", [
    ('he said "go home now" and left', [(2, 4)]), ("« va-t'en » dit-elle", [(0, 2)]), ("„geh jetzt heim“, rief er", [(0, 2)]),
    ('one "word" here "and two" there', [(3, 4)]), ('a stray " mark alone', []), ('"no end here\nand "here it is"', [(4, 6)]),
    ("“he said \"you fool\" to us” she wrote", [(0, 5)]), ('a 5" pipe and a 6" pipe', []), ("‘so it is’ (\"quite so\").", [(0, 2), (3, 4)]),
    ('open "again "and closed" here', [(2, 3)]), ("", []), ("\n\n", [])])
def test_quotations_of_several_words(text, spans):
    assert toxicity.quotations(text) == spans


def test_a_reported_sentence_scores_below_plain_abuse(scorer):
    abuse = "go home you utter idiot and never come back"
    plain = scorer.score(abuse)[0]
    for reported in (f'"{abuse}" reported by a court', f"the witness testified: “{abuse}”.", f"« {abuse} » selon le tribunal"):
        assert scorer.hits(reported)[0][3] == pytest.approx(0.2 * 3.0)
        assert scorer.score(reported)[0] < plain - 0.2
    # quoted, but nobody reports it: shrunk a little; a mark without partner, or one on another line, quotes nothing
    assert scorer.hits(f'"{abuse}"')[0][3] == pytest.approx(0.7 * 3.0)
    assert scorer.score(f'"{abuse}')[0] == scorer.score(f'"\n{abuse}\n"')[0] == plain
    # abuse beside a quotation counts in full
    assert scorer.hits('the court said "come home now" oh dear, you idiot, go away now for good')[0][3] >= 3.0 * 0.7


def test_positions_of_quotations_are_those_of_the_words():
    text = "a\x0b\"b c\x1c d\"\x85e  \"f\tg\" h"
    words = text.split()
    assert [[words[a], words[z]] for a, z in toxicity.quotations(text)] == [['"f', 'g"']]
