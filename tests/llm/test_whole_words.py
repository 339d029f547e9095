"""op9_attention_scores: frequent words are symbols of their own, and what a training step skips doesn't count."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from prosemill.llm import arrowtext as A
from prosemill.llm import attention as M

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def hashes(words):
    data, at = M._bytes_of(pa.array([w.encode() for w in words], pa.large_binary()))
    return A.xxh64(data, at[:-1], at[1:]).view(np.int64)


@pytest.mark.parametrize("frequent", [[], ["thon"], ["thon", "ünï", "zzz,", "never-there"]])
def test_symbols_of_frequent_words(frequent):
    texts = ["Thon erouonou ZZZ, thon", None, "", "ünï thon " * 5 + "漢字", "thonthon"]
    whole = np.sort(hashes(frequent))
    own = {w: M.SYMBOLS + int(np.searchsorted(whole, h)) for w, h in zip(frequent, hashes(frequent))}
    symbols, at, _ = M.Words(pa.array(texts), whole=whole).sequences()
    for t, i, j in zip(texts, at, at[1:]):
        want = []
        for word in (t or "").lower().split():
            ids = TOKENIZER.encode(" " + word, add_special_tokens=False).ids
            want += [own[word]] if word in own else [*(2 * x for x in ids[:-1]), 2 * ids[-1] + 1]
        assert symbols[i:j].tolist() == [*want, M.END]


def test_a_frequent_word_takes_one_place(spark, monkeypatch):
    """Whatever its spelling takes: four symbols here, so there were four times as many windows."""

    class Seen(Exception):
        pass

    def seen(windows, class_of):
        raise Seen(windows.count(), len(class_of))

    monkeypatch.setattr(M, "fitted", seen)
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.expr("repeat('erouonounea ', 3000)").alias("text"))
    with pytest.raises(Seen) as found:
        M.language_scores(docs)
    n = int((~M.held_out(list(range(40)))).sum())
    assert found.value.args == (n * -(-3001 // M.STEP), M.SYMBOLS + 1)


def test_gradients_of_scored_places_alone():
    """A step whose first CONTEXT places have no weight is that of a step that goes through all places."""
    rng = np.random.default_rng(3)
    x, t = rng.integers(0, M.CLASSES, (2, 70, M.L))
    w, weight = M.initial(), np.zeros((70, M.L), np.float32)
    weight[:, M.CONTEXT :] = rng.random((70, M.STEP)) < 0.8
    z, z_part = M.forward(w, x)[0].reshape(70, M.L, M.D), M.forward(w, x, M.CONTEXT)[0].reshape(70, M.STEP, M.D)
    assert np.abs(z[:, M.CONTEXT :] - z_part).max() < 1e-4
    loss, g = M.gradients(w, x, t, weight)
    more = np.concatenate([weight, np.zeros((1, M.L), np.float32)])
    more[-1, 0] = 1  # one more window with weight on its first place: all places are gone through
    last_x, last_t = rng.integers(0, M.CLASSES, (2, 1, M.L))
    whole_loss, whole = M.gradients(w, np.concatenate([x, last_x]), np.concatenate([t, last_t]), more)
    one_loss, one = M.gradients(w, last_x, last_t, more[-1:])
    n = weight.sum()
    assert whole_loss * (n + 1) == pytest.approx(loss * n + one_loss, rel=1e-5)
    for k in g:
        assert np.allclose(whole[k] * (n + 1), g[k] * n + one[k], atol=2e-3), k
