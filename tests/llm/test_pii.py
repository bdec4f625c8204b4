import hashlib
import random
import re

import pytest

from logsift.llm import pii

SCHEMA = "doc_id long, text string, spans string, n_email int"


def brute(t):
    t = t or ""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"[^0-9]", "", m[0])
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def sample_texts(n, seed):
    rng = random.Random(seed)
    bits = ["a", "b.c", "@", ".", "x@y.zz", "a@b.c@d.e", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1111", "12",
            " ", "-", "+1 (555) 123-4567", "+49 30 1234567", "++", "é", "😀", "\n", "5500005555555559", "007.08.09.010", "word", "%+@q-r.s"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    return pii.fit(sample_texts(150, 1), steps=25)


def test_base_spans_equal_the_patterns():
    for t in sample_texts(4000, 2):
        assert pii.base_spans(t) == brute(t), repr(t)


def test_long_runs_take_linear_time():
    for t in ("1" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+1" + " " * 200_000, "@" * 100_000):
        pii.base_spans(t)


def test_rows_with_nulls_and_clashing_columns(spark, model):
    rows = [(i if i % 5 else None, t, "s", 1) for i, t in enumerate([None, "", "x" * 100_000 + " me@here.org"] + sample_texts(300, 3))]
    got = pii.find_personal_data(spark.createDataFrame(rows, SCHEMA).repartition(3), model).collect()
    want = [(d, *[sum(k == i for k, *_ in brute(t)) for i in range(4)], hashlib.sha256(pii.joined(brute(t)).encode()).hexdigest()) for d, t, *_ in rows]
    assert sorted(str(tuple(r)[:6]) for r in got) == sorted(map(str, want))
    assert pii.find_personal_data(spark.createDataFrame([], SCHEMA), model).count() == 0
    by_hash = {w[5]: {pii.joined([s]) for s in brute(t)} for w, (_, t, *_) in zip(want, rows)}
    assert all(by_hash[r.base_sha256] <= set(r.spans.split(",")) for r in got)


def test_crf_gradient_by_differences():
    import numpy as np
    rng = np.random.default_rng(0)
    em, tr, y = rng.normal(size=(5, 3, 4)), rng.normal(size=(4, 4)), rng.integers(0, 4, (5, 3))
    _, d_em, d_tr = pii.crf_gradient(em, tr, y)
    for arr, grad, at in ((em, d_em, (2, 1, 3)), (tr, d_tr, (1, 2))):
        arr[at] += 1e-5
        up = pii.crf_gradient(em, tr, y)[0]
        arr[at] -= 2e-5
        down = pii.crf_gradient(em, tr, y)[0]
        arr[at] += 1e-5
        assert abs((up - down) / 2e-5 - grad[at]) < 1e-6


def test_addresses_with_few_digits_can_be_spans():
    ip, phone = pii.KINDS.index("ip"), pii.KINDS.index("phone")
    assert all(pii.well_formed(ip, pii.classes(t)) for t in ("8 . 8 . 8 . 8", "10,0,0,1", "8.8.8.8"))
    assert not pii.well_formed(ip, pii.classes("1.2.3")) and not pii.well_formed(phone, pii.classes("+49 12"))


def test_all_gradients_by_differences():
    import numpy as np
    rng = np.random.default_rng(1)
    h = pii.HIDDEN
    shapes = {"fx": (pii.N_CLASSES, 4 * h), "fh": (h, 4 * h), "fb": (4 * h,), "bx": (pii.N_CLASSES, 4 * h), "bh": (h, 4 * h), "bb": (4 * h,),
              "ow": (2 * h, pii.TAGS), "ob": (pii.TAGS,), "tr": (pii.TAGS, pii.TAGS)}
    p = {k: rng.normal(0, 0.4, s) for k, s in shapes.items()}
    x, y = rng.integers(0, 4, (7, 3)), rng.integers(0, pii.TAGS, (7, 3))
    _, g = pii.gradients(p, x, y)
    for k, a in p.items():
        at = np.unravel_index(np.argmax(np.abs(g[k])), a.shape)  # fx and bx: a class that occurs
        a[at] += 1e-5
        up = pii.gradients(p, x, y)[0]
        a[at] -= 2e-5
        down = pii.gradients(p, x, y)[0]
        a[at] += 1e-5
        assert abs((up - down) / 2e-5 - g[k][at]) < 1e-6, k


def test_marginals_and_best_path_equal_all_paths():
    from itertools import product
    import numpy as np
    rng = np.random.default_rng(2)
    em, tr = rng.normal(size=(4, 2, 3)), rng.normal(size=(3, 3))
    alpha, beta, z = pii.forward_backward(em, tr)
    best = pii.viterbi(em, tr)
    for n in range(2):
        paths = {p: sum(em[s, n, p[s]] for s in range(4)) + sum(tr[p[s - 1], p[s]] for s in range(1, 4)) for p in product(range(3), repeat=4)}
        whole = sum(np.exp(v) for v in paths.values())
        assert tuple(best[:, n]) == max(paths, key=paths.get) and abs(np.log(whole) - z[n]) < 1e-9
        for s, k in product(range(4), range(3)):
            want = sum(np.exp(v) for p, v in paths.items() if p[s] == k) / whole
            assert abs(np.exp(alpha[s, n, k] + beta[s, n, k] - z[n]) - want) < 1e-9


def made_texts(n, seed):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice(["and", "the", "call", "see", "of", "to"]) for _ in range(n))
    item = [lambda: f"{rng.choice('abcd')}{rng.choice('efgh')}ann@{rng.choice(['mail', 'post'])}.org", lambda: f"+49 30 {rng.randint(1000000, 9999999)}"]
    return [f"{say(6)} {rng.choice(item)()} {say(6)}" for _ in range(n)]


@pytest.fixture(scope="module")
def taught():
    return pii.fit(made_texts(400, 11))


def test_network_learns_the_labelled_spans(taught):
    held = made_texts(100, 12)
    found = pii.network_spans(held, taught)
    assert sum(set(pii.base_spans(t)) <= set(f) for t, f in zip(held, found)) >= 95


def test_network_adds_spans_that_the_patterns_miss(taught):
    import numpy as np
    rng = np.random.default_rng(4)
    held = [pii.rewritten(t, pii.base_spans(t), rng) for t in made_texts(100, 13)]
    missed = [(t, [s for s in spans if not any(s[1] < e and b < s[2] for _, b, e in pii.base_spans(t))]) for t, spans in held]
    found = pii.network_spans([t for t, _ in missed], taught)
    asked = sum(len(s) for _, s in missed)
    hit = sum(any(k == f[0] and a < f[2] and f[1] < e for f in got) for (_, spans), got in zip(missed, found) for k, a, e in spans)
    false = sum(not any(f[1] < e and a < f[2] for _, a, e in spans) for (_, spans), got in zip(held, found) for f in got)
    assert asked >= 50 and hit >= 0.9 * asked and false <= 5
    plain = ["call the number 12 or see 3 of 4, to 10:30 and 2024-01-01", "version 1.2 and the 5th of 7", "see me @ home"]
    assert sum(map(len, pii.network_spans(plain, taught))) <= 1
