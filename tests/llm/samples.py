"""Small documents with what every operator has to take: nulls, empty texts, repeats, near copies, long texts."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def words(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    common = ["the", "of", "and", "to", "in"]
    return [rng.choice(common) if rng.random() < 0.3 else "".join(rng.choice(LETTERS) for _ in range(rng.randint(3, 8))) for _ in range(n)]


def rows() -> list[tuple]:
    out = []
    for i in range(60):
        w = words(20 + 7 * i, i)
        text = " ".join(w).capitalize() + "."
        if i % 10 == 3:
            text = out[i - 1][1]
        if i % 10 == 5:
            previous = out[i - 1][1].split(" ")
            previous[len(previous) // 2] = "changed"
            text = " ".join(previous)
        out.append((i, text, "en", f"src{i % 4}", len(text)))
    out += [(60, None, "en", None, 0), (61, "", None, "src1", 0), (62, " \t\n", "en", "src1", 3), (63, "Hi", "en", "src9", 2), (None, "no id at all here", "en", "src0", 17)]
    out += [(64, "Naïve café — déjà vu ☃ 12,5 kg", "fr", "src2", 30), (65, " ".join(words(9000, 99)), "en", "src0", 0)]
    out += [out[7], out[7]]
    return out


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
