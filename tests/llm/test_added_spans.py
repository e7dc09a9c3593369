"""The field finds secrets that no base pattern matches, and leaves prose with numbers alone."""

import random
import string

from skyquilt.llm import secrets


def test_secrets_without_a_keyword_are_found():
    rng = random.Random(8)
    of = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    prose = lambda: [of(string.ascii_lowercase, rng.randint(2, 9)) if rng.random() < 0.95 else of(string.digits, rng.randint(1, 5)) for _ in range(60)]

    def planted(secret):
        words = prose()
        words.insert(rng.randrange(len(words)), secret)
        return " ".join(words)

    taught = [planted(f'token = "{of("0123456789abcdef", 40)}"') for _ in range(80)] + [" ".join(prose()) for _ in range(80)]
    field = secrets.Field.fit(*secrets._pieces(taught))
    letters = string.ascii_letters + string.digits
    hidden = [rng.choice(["ghp_", "sk-", "key/"]) + of(letters, rng.randint(24, 36)) for _ in range(100)]
    found = list(secrets.find([planted(x) for x in hidden], field))
    assert sum(any(k == "crf" and b - a >= len(x) - 1 for a, b, k in spans) for x, spans in zip(hidden, found, strict=True)) >= 90
    assert not any(secrets.find([" ".join(prose()) for _ in range(200)], field))
