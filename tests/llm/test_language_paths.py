"""Viterbi in parts, and word scores all at once, equal the plain ways."""

import math

import numpy as np
import pytest

from quillrank.llm import language_spans


def plain_path(scores, switch):
    """One text, word by word."""
    best, back = scores[0].astype(float), []
    for own in scores[1:]:
        top = int(best.argmax())
        stay = best >= best[top] - switch
        back.append(np.where(stay, np.arange(len(best)), top))
        best = np.where(stay, best, best[top] - switch) + own
    label = [int(best.argmax())]
    for step in reversed(back):
        label.append(int(step[label[-1]]))
    return label[::-1]


@pytest.mark.parametrize("states", [1, 2, 4, 200])
def test_parts_between_certain_words_equal_the_whole(states):
    draw = np.random.default_rng(states)
    lengths = [0, 1, 2, 700, 0, 31, 1]
    scores = []
    for n in lengths:
        own = draw.normal(size=(n, states)) * draw.choice([0.3, 2.0, 9.0], size=(n, 1))
        own[draw.random(own.shape) < 0.2] = -np.inf
        own[np.arange(n), draw.integers(0, states, n)] = 0.0  # a candidate at least
        scores.append(own)
    cut = np.concatenate([language_spans.certain(own, 2.0) for own in scores])
    assert states == 1 or (0 < (cut >= 0).sum() < len(cut))
    for own, labels in zip(scores, language_spans.viterbi(scores, 2.0)):
        assert labels.tolist() == (plain_path(own, 2.0) if len(own) else [])


def test_words_scored_at_once_equal_sums_over_their_ngrams():
    languages = ["aa", "bb", "cc"]
    draw = np.random.default_rng(5)
    grams = sorted({g for word in ("stone", "été", "камень", "石头", "o") for g in language_spans.word_ngrams(word)})
    rows = {gram: 5 + i for i, gram in enumerate(grams)}
    weights = np.vstack([np.zeros((1, 3)), draw.normal(size=(4 + len(grams), 3))])
    model = language_spans.LanguageModel(languages, rows, weights, {"latin": [0, 1], "cyrillic": [2]})
    words = ["stone", "o", "stones", "étéo", "камень", "石头", "zzz", "stoкам", "\U0001d400b"]
    got = model.scores(words)
    for word, own in zip(words, got):
        total = sum(weights[rows.get(g, len(g))] for g in language_spans.word_ngrams(word)) / 4
        allowed = model.candidates(word)
        norm = math.log(sum(math.exp(total[i]) for i in allowed))
        expected = [total[i] - norm if i in allowed else -math.inf for i in range(3)]
        assert own.tolist() == pytest.approx(expected)


def test_words_are_runs_of_letters_and_marks():
    assert language_spans.WORDS.findall("été ́a1b ́́ x-y") == ["été", "́a", "b", "x", "y"]
    assert language_spans.WORDS.findall("́" * 200_000) == []
