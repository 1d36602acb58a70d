"""A bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are words and their character n-grams.  ``fit`` trains on windows of
labelled texts; ``Scorer`` scores windows with input projections kept per word,
so that the recurrence does only its own work at each step.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from itertools import chain

import numpy as np

WINDOW, STRIDE = 16, 8
WORD_DIM, CHAR_DIM, HIDDEN, CHAR_BUCKETS = 16, 16, 16, 4096
#: Letters of a piece of a long word and of a run of a script without spaces, and
#: from one piece to the next, so that pieces overlap and no letter is left out.
PIECE, PIECE_STEP, DENSE_PIECE, DENSE_STEP = 16, 10, 4, 2
#: Character inputs of a piece: its beginning and all its 3-grams.
GRAMS = PIECE + 1
#: Of the labelled texts' scores by a network that has not seen them: see ``fit``.
DOUBT, CONTRADICTED, NEGATIVE_BELOW, POSITIVE_ABOVE, CASE_RANGE = 0.95, 0.95, 0.98, 0.9, (0.8, 0.98)
#: Negative windows scored highest that a training round shows more often.
HARD = 3000
#: Words kept by a scorer between batches (about 400 bytes each).
KEPT_WORDS = 60_000

# Look-alike letters of other scripts, and digits and signs written for letters.
_ALIKE = str.maketrans("аеорсухікмтвнзѕјԁӏοαερτυικνωßɡ", "aeopcyxikmtbh3sjdloaeptuikvwsg")
_HIDDEN = dict.fromkeys([0x00AD, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xFEFF])
_LEET = str.maketrans("0134578@$!", "oieastbasi")
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[.\-_*· ][^\W\d_]){3,}(?![^\W_])")
_SIGN = re.compile(r"(?<=[^\W\d_])[@$!](?=[^\W\d_])")
_SIGNS = {"@": "a", "$": "s", "!": "i"}
_WORDS = re.compile(r"[^\W_]+")
#: Letters of scripts written without spaces: Thai to Tibetan, Khmer, kana, ideographs.
_DENSE = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_DENSE_LETTER, _RUNS = re.compile(f"[{_DENSE}]"), re.compile(f"[{_DENSE}]+|[^{_DENSE}]+")
_REPEAT = re.compile(r"(.)\1{2,}")


def words(text: str) -> list[str]:
    """Raw words of a text in lower case, with hidden characters removed, look-
    alike letters replaced and words spelled letter by letter joined.  Long words
    and runs of scripts without spaces are given as overlapping pieces."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_HIDDEN).lower().translate(_ALIKE)
        text = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    text = _SPACED.sub(lambda m: re.sub(r"[\W_]", "", m.group()), text.lower())
    if "@" in text or "$" in text or "!" in text:
        text = _SIGN.sub(lambda m: _SIGNS[m.group()], text)
    found = _WORDS.findall(text)
    if all(len(w) <= PIECE for w in found) and (text.isascii() or not _DENSE_LETTER.search(text)):
        return found
    return [piece for w in found for piece in _pieces(w)]


def _pieces(word: str) -> list[str]:
    out: list[str] = []
    for run in _RUNS.findall(word):
        size, step = (DENSE_PIECE, DENSE_STEP) if _DENSE_LETTER.match(run) else (PIECE, PIECE_STEP)
        out += [run[k : k + size] for k in range(0, max(1, len(run) - size + step), step)]
    return out


def plain(word: str) -> str:
    """A word as the network sees it: numbers are one word, digits within
    letters are letters, letters drawn out are single."""
    if word.isdigit():
        return "#"
    if any(c.isdigit() for c in word):
        word = word.translate(_LEET)
    return _REPEAT.sub(r"\1", word)


def grams(word: str) -> list[int]:
    """Buckets of the character 3-grams and the 4-letter beginning of a piece."""
    w = f"<{word}>"
    parts = [w[i : i + 3] for i in range(len(w) - 2)] or [w]
    return [zlib.crc32(p.encode("utf-8", "replace")) % CHAR_BUCKETS for p in [w[:5] + "|", *parts]]


def window_starts(n: int) -> list[int]:
    """Starts of the overlapping windows over n words; the last ends at the end."""
    if n <= WINDOW:
        return [0] if n else []
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


class Network:
    """Parameters by name, and the vocabulary (word -> row; row 0: unknown)."""

    def __init__(self, vocabulary: dict[str, int], classes: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN

        def random(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.vocabulary = vocabulary
        self.case = 0.5
        self.p = {"word": random(len(vocabulary) + 1, WORD_DIM, scale=0.1), "char": random(CHAR_BUCKETS, CHAR_DIM, scale=0.1), "att": random(2 * h, 2 * h, scale=0.2), "attv": random(2 * h, scale=0.2), "out": random(2 * h, classes, scale=0.3), "outb": np.zeros(classes, np.float32)}
        for way in "fb":
            self.p |= {f"w{way}": random(d, 3 * h, scale=d**-0.5), f"u{way}": random(h, 3 * h, scale=h**-0.5), f"c{way}": np.zeros(3 * h, np.float32)}

    def pooled(self, gx: dict[str, np.ndarray], mask: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, ...]:
        """(logits, states, attention, tanh) of projected inputs by way, (steps,
        windows, 3h), and mask (steps, windows)."""
        steps, n = mask.shape
        h, full = HIDDEN, mask.all(axis=1)
        states = np.empty((steps, n, 2 * h), dtype=np.float32)
        for way in "fb":
            u, at = self.p[f"u{way}"], np.zeros((n, h), dtype=np.float32)
            for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
                g, x = at @ u, gx[way][t]
                rz = x[:, : 2 * h] + g[:, : 2 * h]
                rz *= 0.5
                np.tanh(rz, out=rz)
                rz += 1.0
                rz *= 0.5
                r, z = rz[:, :h], rz[:, h:]
                new = r * g[:, 2 * h :]
                new += x[:, 2 * h :]
                np.tanh(new, out=new)
                after = new - at
                after *= 1.0 - z
                if not full[t]:
                    after *= mask[t][:, None]
                after += at
                if keep is not None:
                    keep.append((way, t, at, r, z, new, g[:, 2 * h :]))
                at = after
                states[t, :, (0 if way == "f" else h) : (h if way == "f" else 2 * h)] = at
        tanh = np.tanh(states @ self.p["att"])
        score = tanh @ self.p["attv"] + (mask - 1.0) * 1e4
        score = np.exp(score - score.max(axis=0))
        weight = score / score.sum(axis=0)
        pooled = (states * weight[:, :, None]).sum(axis=0)
        return pooled @ self.p["out"] + self.p["outb"], states, weight, tanh, pooled

    def gradients(self, rows: np.ndarray, gram: np.ndarray, ids: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients for windows ids (steps, windows) of local words,
        whose vocabulary rows are ``rows`` and n-grams ``gram`` (-1: none)."""
        p, h = self.p, HIDDEN
        has = (gram >= 0).astype(np.float32)
        share = has / np.maximum(1.0, has.sum(axis=1, keepdims=True))
        vectors = np.concatenate([p["word"][rows], (p["char"][np.maximum(gram, 0)] * share[:, :, None]).sum(axis=1)], axis=1)
        x = vectors[ids]
        keep: list = []
        gx = {way: x @ p[f"w{way}"] + p[f"c{way}"] for way in "fb"}
        logits, states, weight, tanh, pooled = self.pooled(gx, mask, keep)
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        prob = e / e.sum(axis=1, keepdims=True)
        n = len(target)
        loss = float(-np.log(prob[np.arange(n), target] + 1e-9).mean())
        d_logits = prob.copy()
        d_logits[np.arange(n), target] -= 1.0
        d_logits /= n
        g = {"out": pooled.T @ d_logits, "outb": d_logits.sum(axis=0)}
        d_pooled = d_logits @ p["out"].T
        d_states = weight[:, :, None] * d_pooled
        d_weight = (states * d_pooled).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["attv"] = np.einsum("tn,tnk->k", d_score, tanh)
        d_pre = d_score[:, :, None] * p["attv"] * (1.0 - tanh**2)
        g["att"] = np.einsum("tnk,tnl->kl", states, d_pre)
        d_states = d_states + d_pre @ p["att"].T
        d_x = np.zeros_like(x)
        d_at = {way: np.zeros((n, h), dtype=np.float32) for way in "fb"}
        for way in "fb":
            g[f"u{way}"], d_gx = np.zeros_like(p[f"u{way}"]), np.zeros_like(gx[way])
            lo = 0 if way == "f" else h
            for w, t, at, r, z, new, un in reversed(keep):
                if w != way:
                    continue
                d = d_at[way] + d_states[t, :, lo : lo + h]
                m = mask[t][:, None]
                d_new = d * m * (1.0 - z) * (1.0 - new**2)
                d_z = -d * m * (new - at) * z * (1.0 - z)
                d_r = d_new * un * r * (1.0 - r)
                d_gx[t] = np.concatenate([d_r, d_z, d_new], axis=1)
                d_g = np.concatenate([d_r, d_z, d_new * r], axis=1)
                g[f"u{way}"] += at.T @ d_g
                d_at[way] = d * (1.0 - m * (1.0 - z)) + d_g @ p[f"u{way}"].T
            g[f"w{way}"] = np.einsum("tnd,tnk->dk", x, d_gx)
            g[f"c{way}"] = d_gx.sum(axis=(0, 1))
            d_x += d_gx @ p[f"w{way}"].T
        d_vectors = np.zeros_like(vectors)
        np.add.at(d_vectors, ids, d_x)
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], rows, d_vectors[:, :WORD_DIM])
        np.add.at(g["char"], np.maximum(gram, 0), d_vectors[:, None, WORD_DIM:] * share[:, :, None])
        return loss, g


class Scorer:
    """Class probabilities of all windows of many texts."""

    def __init__(self, network: Network):
        self.network = network
        self._forget()

    def _forget(self) -> None:
        self.row: dict[str, int] = {}
        self.table = {way: np.zeros((0, 3 * HIDDEN), dtype=np.float32) for way in "fb"}

    def _learn(self, fresh: list[str]) -> None:
        p, known = self.network.p, [plain(w) for w in fresh]
        rows = np.array([self.network.vocabulary.get(w, 0) for w in known])
        lists = [grams(w) for w in known]
        gram = np.full((len(known), GRAMS), -1)
        for k, x in enumerate(lists):
            gram[k, : len(x)] = x
        has = (gram >= 0).astype(np.float32)
        char = (p["char"][np.maximum(gram, 0)] * (has / has.sum(axis=1, keepdims=True))[:, :, None]).sum(axis=1)
        x = np.concatenate([p["word"][rows], char], axis=1)
        for k, w in enumerate(fresh):
            self.row[w] = len(self.table["f"]) + k
        for way in "fb":
            self.table[way] = np.concatenate([self.table[way], x @ p[f"w{way}"] + p[f"c{way}"]])

    def windows(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probabilities, text, start) of every window of the texts' words."""
        if len(self.row) > KEPT_WORDS:
            self._forget()
        fresh = sorted({w for t in texts for w in t if w not in self.row})
        for k in range(0, len(fresh), 20_000):
            self._learn(fresh[k : k + 20_000])
        classes = self.network.p["out"].shape[1]
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        starts = [window_starts(n) for n in sizes.tolist()]
        of = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        if not len(of):
            return np.zeros((0, classes), np.float32), np.array([], int), np.array([], int)
        at = np.fromiter(chain.from_iterable(starts), dtype=np.int64, count=len(of))
        flat = np.fromiter(map(self.row.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=int(sizes.sum()))
        before = np.cumsum(sizes) - sizes
        place = (before[of] + at) + np.arange(WINDOW)[:, None]
        inside = place < (before + sizes)[of]
        block = np.where(inside, flat[np.minimum(place, len(flat) - 1)], -1)
        out = []
        for k in range(0, block.shape[1], 512):
            part = np.ascontiguousarray(block[:, k : k + 512])
            mask = (part >= 0).astype(np.float32)
            logits = self.network.pooled({way: self.table[way][np.maximum(part, 0)] for way in "fb"}, mask)[0]
            e = np.exp(logits - logits.max(axis=1, keepdims=True))
            out.append(e / e.sum(axis=1, keepdims=True))
        return np.concatenate(out), of, at


def _adam(p: dict, g: dict, m: dict, v: dict, t: int, rate: float) -> None:
    for k in p:
        m[k] = 0.9 * m[k] + 0.1 * g[k]
        v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
        p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)


class _Sample:
    """Labelled texts as rows of a local word list."""

    def __init__(self, texts: list[list[str]], labels: list[int], classes: int):
        self.texts, self.labels, self.classes = texts, labels, classes
        plained = [[plain(w) for w in t] for t in texts]
        self.counts = Counter(w for t in plained for w in set(t))
        self.vocabulary = {w: k + 1 for k, w in enumerate(sorted(w for w, n in self.counts.items() if n >= 3))}
        local: dict[str, int] = {}
        for t in plained:
            for w in t:
                local.setdefault(w, len(local))
        self.plained = plained
        self.coded = [np.array([local[w] for w in t]) for t in plained]
        self.rows = np.array([self.vocabulary.get(w, 0) for w in local])
        self.gram = np.full((len(local), GRAMS), -1)
        for k, w in enumerate(local):
            x = grams(w)
            self.gram[k, : len(x)] = x

    def telling(self, positive: list[int], negative: list[int]) -> dict[int, int]:
        """The window of each positive text with the most telling words, by the
        log odds of a positive or a negative text to hold them."""
        held = Counter(w for k in positive for w in set(self.plained[k]))
        other = Counter(w for k in negative for w in set(self.plained[k]))
        odds = {w: max(0.0, np.log((n + 0.1) / (len(positive) + 1)) - np.log((other[w] + 0.5) / (len(negative) + 1))) for w, n in held.items() if n >= 2}
        out = {}
        for k in positive:
            total = np.r_[0.0, np.cumsum([odds.get(w, 0.0) for w in self.plained[k]])]
            n = len(total) - 1
            out[k] = max(window_starts(n), key=lambda s: total[min(n, s + WINDOW)] - total[s])
        return out

    def batch(self, picks: list[tuple[int, int, int]], rng: np.random.Generator) -> tuple:
        ids = np.zeros((WINDOW, len(picks)), dtype=np.int64)
        mask = np.zeros((WINDOW, len(picks)), dtype=np.float32)
        for c, (k, s, _) in enumerate(picks):
            part = self.coded[k][s : s + WINDOW]
            ids[: len(part), c] = part
            mask[: len(part), c] = 1.0
        used, back = np.unique(ids, return_inverse=True)
        own = self.rows[used].copy()
        own[rng.random(len(own)) < 0.2] = 0  # words unknown to the vocabulary occur, too
        return own, self.gram[used], back.reshape(ids.shape), mask, np.array([c for _, _, c in picks])

    def top_windows(self, net: Network, of_texts: list[int]) -> tuple[dict[int, tuple[float, int]], list[tuple[float, int, int]]]:
        """(score and start of each text's highest window, all windows scored
        0.02 or more) by the network."""
        prob, of, at = Scorer(net).windows([self.texts[k] for k in of_texts])
        score = 1.0 - prob[:, 0]
        top: dict[int, tuple[float, int]] = {}
        for w in range(len(of)):
            k = of_texts[of[w]]
            if k not in top or score[w] > top[k][0]:
                top[k] = (float(score[w]), int(at[w]))
        return top, [(float(score[w]), of_texts[of[w]], int(at[w])) for w in np.flatnonzero(score >= 0.02)]


def _train(net: Network, sample: _Sample, steps: int, chosen: dict[int, int], negative: list[int], hard: list[tuple[int, int]], rng: np.random.Generator, rate: float, batch: int = 64) -> None:
    """Steps on half chosen windows of positive texts, half windows of negative
    ones, of these half from ``hard``; the rate falls to nothing at the end."""
    by_class = [x for c in range(1, sample.classes) if (x := [k for k in chosen if sample.labels[k] == c])]
    every = [*chosen]
    m, v = ({k: np.zeros_like(x) for k, x in net.p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        picks = []
        for n in range(batch // 2):
            pool = by_class[n % len(by_class)] if n % 2 else every
            k = pool[rng.integers(len(pool))]
            picks.append((k, int(np.clip(chosen[k] + rng.integers(-6, 7), 0, max(0, len(sample.coded[k]) - WINDOW))), sample.labels[k]))
        for n in range(batch - batch // 2):
            if hard and n % 2:
                k, s = hard[rng.integers(len(hard))]
            else:
                k = negative[rng.integers(len(negative))]
                s = int(rng.integers(max(1, len(sample.coded[k]) - WINDOW + 1)))
            picks.append((k, s, 0))
        _, g = net.gradients(*sample.batch(picks, rng))
        _adam(net.p, g, m, v, step, rate * (1.05 - step / steps))


def _log_odds(score: np.ndarray) -> np.ndarray:
    inside = np.clip(score, 1e-6, 1 - 1e-6)
    return np.log(inside / (1 - inside))


def fit(texts: list[list[str]], labels: list[int], classes: int, agreed: list[bool] | None = None, steps: tuple[int, int, int] = (200, 250, 350), seed: int = 5) -> Network:
    """A network for texts (raw words) with a label each (0: none); agreed:
    whether two reviewers gave it.

    A text's label holds for some window of it, and labels may be wrong.  So
    two networks are trained first, each on one half, with the windows of most
    telling words; each then scores the other half and chooses its windows.  A
    positive text is left out if it scores no higher than DOUBT of the negative
    ones do, unless two reviewers agree on it; a negative one if it scores
    CONTRADICTED or more.  The network itself is trained on what is left, in two
    rounds; before the second it chooses the windows again, and the negative
    windows scored highest.  The number of steps is fixed, whatever the number
    of texts.  ``network.case``, the score from which a document is a case, is
    the middle in log odds between what NEGATIVE_BELOW of the other half's
    negative texts stay below and what POSITIVE_ABOVE of its positive ones reach."""
    rng = np.random.default_rng(seed)
    sample = _Sample(texts, labels, classes)
    net = Network(sample.vocabulary, classes, seed)
    usable = [k for k, t in enumerate(texts) if t]
    positive, negative = [k for k in usable if labels[k]], [k for k in usable if not labels[k]]
    if not positive or not negative:
        net.p["outb"][0] = 20.0  # nothing to learn from: no text is scored as a case
        return net
    chosen, hard = sample.telling(positive, negative), []
    if len(positive) > 1 and len(negative) > 1:  # a text in either half
        held, start, windows = np.zeros(len(texts)), {}, []
        for half in (0, 1):
            own_p, own_n = positive[half::2], negative[half::2]
            judge = Network(sample.vocabulary, classes, seed + 1 + half)
            _train(judge, sample, steps[0], sample.telling(own_p, own_n), own_n, [], rng, 5e-3)
            top, found = sample.top_windows(judge, positive[1 - half :: 2] + negative[1 - half :: 2])
            windows += found
            for k, (score, at) in top.items():
                held[k], start[k] = score, at
        doubt = np.quantile(held[negative], DOUBT)
        kept = [k for k in positive if held[k] >= doubt or (agreed is not None and agreed[k])]
        clean = [k for k in negative if held[k] < CONTRADICTED]
        if kept and clean:
            positive, negative, chosen = kept, clean, {k: start[k] for k in kept}
            known = set(clean)
            hard = [(k, s) for _, k, s in sorted((w for w in windows if w[1] in known), reverse=True)[:HARD]]
            ends = _log_odds(np.array([np.quantile(held[clean], NEGATIVE_BELOW), np.quantile(held[kept], 1 - POSITIVE_ABOVE)]))
            net.case = float(np.clip(1 / (1 + np.exp(-ends.mean())), *CASE_RANGE))
    _train(net, sample, steps[1], chosen, negative, hard, rng, 5e-3)
    top, windows = sample.top_windows(net, positive + negative)
    chosen = {k: top[k][1] for k in positive}
    known = set(negative)
    hard = [(k, s) for _, k, s in sorted((w for w in windows if w[1] in known), reverse=True)[:HARD]]
    _train(net, sample, steps[2], chosen, negative, hard, rng, 3e-3)
    return net
