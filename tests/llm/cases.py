"""Documents with nulls, empty and long texts, ties, repeats, odd white space and extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, spans string, words string, key string, rule string"


def texts() -> list[str | None]:
    rng = random.Random(7)
    vocab = ["alpha", "Beta", "gamma", "naïve", "Straße", "ok,", "don't", "x1", "42", "été", "###", "a|b", "日本語", "mañana", "over", "under", "<|endoftext|>", "I'm", "e\u0301t"]
    out: list[str | None] = [None, "", " ", "\n", "\n\n", "a", " a", "a ", "a\n", "\na", "a  b", "a\n\nb", "a \n b", "a\tb\r\nc", "a\xa0b", "a\u3000 b", "x\x1cy \x1f z", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<|startoftext|>hi", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "  lead", "İstanbul ΣΑΣ", "\u0301 x \u0301", "emoji 👩‍💻 ok 😀😀", "same text here", "same text here"]
    for n in (3, 9, 10, 11, 60, 200):
        out.append(" ".join(rng.choice(vocab) for _ in range(n)))
        out.append("".join(rng.choice(vocab) + rng.choice([" ", "\n", "  ", "\t", ""]) for _ in range(n)))
    out.append("".join(rng.choice("abcdefghij") for _ in range(6000)))
    out.append(" ".join(rng.choice(vocab[:12]) for _ in range(30_000)))
    return out


def documents(spark, values=None):
    values = texts() if values is None else values
    rows = [(i, t, "en" if i % 3 else None, "s", None, "clash", "clash", "clash", "clash", "clash") for i, t in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)
