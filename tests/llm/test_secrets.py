"""Texts with very many secrets."""

import random
import time

from tessera.llm.op06_secrets import CANDIDATE, all_spans, base_spans, mean_ratio, train


def plain_spans(text, model, threshold):
    base = base_spans(text)
    more = [(m.start(), 3, m.end()) for m in CANDIDATE.finditer(text)
            if not m.group().isalpha() and not m.group().isdigit() and not any(a < m.end() and m.start() < e for a, _, e in base) and mean_ratio(model, m.group()) > threshold]
    return sorted(base + more)


def mixed_text(rng, n):
    hexes = lambda k: "".join(rng.choices("0123456789abcdef", k=k))
    parts = (lambda: hexes(40), lambda: "password=" + hexes(9), lambda: "AKIA" + "".join(rng.choices("ABCDEFGH0123", k=18)), lambda: "".join(rng.choices("ABCxyz019+/", k=rng.randint(10, 60))), lambda: "token: x=" + hexes(30), lambda: "ordinary_identifier_name1", lambda: "-=" + hexes(30) + "=-/")
    return rng.choice([" ", "", "\n", "!"]).join(rng.choice(parts)() for _ in range(n))


def test_one_sweep_equals_all_pairs_of_spans():
    rng, model = random.Random(3), train(["ordinary", "identifier", "name", "the", "token"])
    for _ in range(150):
        text = mixed_text(rng, rng.randint(0, 40))
        assert all_spans(text, model, 0.5) == plain_spans(text, model, 0.5)


def test_megabytes_of_secrets_take_seconds():
    rng, model = random.Random(4), train(["ordinary", "identifier"])
    text = " ".join(mixed_text(rng, 50) for _ in range(6000))
    assert len(text) > 8_000_000
    began = time.process_time()
    assert len(all_spans(text, model, 0.5)) > 200_000
    assert time.process_time() - began < 30
