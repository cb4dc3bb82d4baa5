"""A small table with everything that is awkward: NULLs, copies, long texts, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tag long, h string, node string, digest string"


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmno") for _ in range(r.randint(2, 8))) for _ in range(n))


def rows():
    base, passage = words(1, 200), words(2, 60)
    near = base.split()
    near[100] = "changed"
    texts = [
        None,
        "",
        " \t\n",
        "one two three",
        "One TWO three",
        base,
        base,
        " ".join(near),
        words(3, 40) + " " + passage + " " + words(4, 30),
        words(5, 10) + "\n" + passage + "\n" + words(6, 90),
        "Ünïcode ñandú 😀 mail a.b@mail.example.com, 1.2.3.4 and 999.1.1.1 +1 (017) 555-7713",
        "card 4539 1488 0343 6467, 4539148803436468, x@y a@b.c_d@e.f 1.2.3.4.5.6.7.8",
        words(7, 30000),
        "x" * 150_000,
        "12-" * 3000 + "9",
        "ends <|endoftext|> here, not<|startoftext|>there; it's l'État",
    ]
    out = [(k, t, "en", f"src{k % 3}", None, k, "h", "n", "d") for k, t in enumerate(texts)]
    out += [out[5], out[5]]  # repeated rows
    out += [(None, base, None, None, None, None, None, None, None), (100, base, None, None, 1, 1, None, None, None)]
    return out
