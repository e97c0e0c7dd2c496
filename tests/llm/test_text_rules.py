import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece

from shoplark.llm import quality_rules
from shoplark.llm.decontaminate import decontamination_digest, find_benchmark_spans
from shoplark.llm.quality_rules import judge_quality
from shoplark.llm.url_filter import filter_urls

from .cases import documents, texts

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_contamination(text, items, window=10):
    words = WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item_id, item in items:
        own = WORD.findall((item or "").translate(LOWER))
        size = min(window, len(own))
        grams = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1 if size else 0):
            if tuple(words[i : i + size]) in grams:
                hit.update(range(i, i + size))
                found.add("" if item_id is None else str(item_id))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_decontamination_equals_brute_force_in_any_number_of_blocks(spark):
    rng = random.Random(5)
    vocab = ["a", "b", "c", "dé", "E", "f9"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate((1, 2, 3, 9, 10, 11, 14, 30, 12, 10))]
    items += [(90, None), (91, ""), (92, "?!"), (93, items[7][1]), (10, "zz yy zz yy"), (11, "zz"), (None, "qq rr ss"), (None, "zz zz")]
    values = texts() + [items[7][1] * 3, "x " + items[5][1].upper().replace(" ", "--") + " y", items[6][1][3:], "zz " * 50, "a qq rr ss", "x " * 3000 + items[7][1], "qq rr", "ss zz"]
    values += [" ".join(rng.choice(vocab) for _ in range(400)) for _ in range(10)]
    bench = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string")
    for size in (1 << 20, 64):
        got = {r[0]: tuple(r)[1:] for r in decontamination_digest(find_benchmark_spans(documents(spark, values), bench, item_bytes=size)).collect()}
        assert got == {i: brute_contamination(t, items) for i, t in enumerate(values)}
    none = decontamination_digest(find_benchmark_spans(documents(spark, values), bench.limit(0))).collect()
    assert not any(r.contaminated for r in none) and len(none) == len(values)


def brute_counts(text):
    words = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\\x20\\x09-\\x0D]", x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    again = {j for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)


MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute_fertility(text, lib):
    """n_tokens, characters per token, byte share, entropy, main script; one word at a time."""
    words = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
    ids = [i for w in words for i in lib.encode(w)]
    if not ids:
        return 0, 0.0, 0.0, 0.0, "other"
    counts = Counter(ids)
    scripts = Counter()
    for c in map(ord, "".join(words)):
        name = next((n for n, a, b in quality_rules.SCRIPTS if a <= c <= b), "other" if c > 0x24F else None)
        scripts[name] += name is not None
    main = max(quality_rules.SCRIPT_NAMES, key=lambda n: scripts[n]) if sum(scripts.values()) else "other"
    return len(ids), sum(map(len, words)) / len(ids), sum(map(lib.is_byte, ids)) / len(ids), -sum(n / len(ids) * math.log2(n / len(ids)) for n in counts.values()), main


def brute_verdicts(values, langs, width=5.0, least=100):
    """(base_failed, kept, reason) of each text, by the rules as they are written."""
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = []
    for t, lang in zip(values, langs):
        n, _, _, _, repeats = brute_counts(t)
        rows.append((lang, n < 50 or 2 * repeats > n, *brute_fertility(t, lib)))
    places = {"chars": 3, "bytes": 4, "bits": 5}
    bands = {}
    for kind, at in (("lang", 0), ("script", 6)):
        for name in {r[at] for r in rows} - {None}:
            fit = [r for r in rows if r[at] == name and not r[1] and r[2] >= 64]
            if len(fit) < least:
                continue
            band = {}
            for m, k in places.items():
                floor, bins = quality_rules.FLOORS[m]
                q = np.percentile([math.floor(r[k] * bins) for r in fit], (25, 50, 75))
                wide = width * max((q[2] - q[0]) / bins / 1.349, floor)
                band[m] = ((q[1] + 0.5) / bins - wide, (q[1] + 0.5) / bins + wide)
            bands[kind, name] = band["chars"][0], band["chars"][1], band["bytes"][1], band["bits"][0]
    out = []
    for lang, failed, n, chars, share, bits, script in rows:
        b = bands.get(("lang", lang)) or bands.get(("script", script)) or tuple(vars(quality_rules.SCRIPT_BANDS[script]).values())
        reason = "base" if failed else "chars_per_token" if not b[0] <= chars <= b[1] else "byte_share" if share > b[2] else "token_entropy" if n >= 64 and bits < b[3] else None
        out.append((failed, reason is None, reason))
    return out, bands


PROSE = "It was late in the day and the two of them had walked for hours along the river without a word, past the mill, the old bridge and a row of poplars that someone must have planted long before the road was built, until the town lay behind and only fields were left to see on either side."


def test_quality_equals_brute_force(spark):
    values = [*texts(), "a b a b a b\na b\n\n \na b\nq", "x\x0by\x0cz x\x0by\x0cz", PROSE, "ÃÂ\x9d" * 90 + " ".join("\x93ǁ" * 3 for _ in range(60)), "go " * 80]
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in judge_quality(documents(spark, values), MODEL).collect()}
    for i, t in enumerate(values):
        want, r = brute_counts(t), got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        tokens, *measures, script = brute_fertility(t, lib)
        assert (r.n_tokens, r.script) == (tokens, script)
        assert np.allclose((r.chars_per_token, r.byte_share, r.token_entropy), measures)
    langs = ["en" if i % 3 else None for i in range(len(values))]
    assert [(got[i].base_failed, got[i].kept, got[i].reason) for i in range(len(values))] == brute_verdicts(values, langs)[0]
    assert [got[len(values) - 3 + i].kept for i in range(3)] == [True, False, False]
    assert judge_quality(documents(spark, []), MODEL).count() == 0


def test_fitted_bands_reject_what_is_outside(spark):
    rng = random.Random(8)
    vocab = [w.strip(".,") for w in PROSE.split()]
    junk = [w + "$%#"[i % 3] * 3 for i, w in enumerate(vocab)]
    values, langs = [], []
    for i in range(400):
        pick = junk if i % 40 == 7 else ["ÃÂ\x9d", "Ã©Â\x80"] if i % 100 == 50 else vocab
        values.append(" ".join(rng.choice(pick) + rng.choice(["", "", "s"]) for _ in range(150)))
        langs.append(rng.choice(["en", "en", "xx", None]) if i % 5 else "rare")
    rows = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(zip(values, langs))], "doc_id long, text string, lang string").repartition(5)
    want, bands = brute_verdicts(values, langs, least=80)
    assert ("lang", "rare") not in bands and ("script", "latin") in bands and ("lang", "en") in bands
    got = {r.doc_id: (r.base_failed, r.kept, r.reason) for r in judge_quality(rows, MODEL, least_documents=80).collect()}
    assert [got[i] for i in range(400)] == want
    outside = [i for i in range(400) if want[i][2] not in (None, "base")]
    assert {i for i in range(400) if i % 40 == 7} <= set(outside) and len(outside) < 40


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"), ("block", "a.b.example.com", ""), ("allow", "example.com", "/en/x")]


def brute_rule(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOWER)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[2:] if fits else (None, "allow"))


def test_url_rules_equal_brute_force_in_any_number_of_sweeps(spark):
    hosts = ["example.com", "WWW.Example.com", "xexample.com", "a.b.example.com", "z.a.b.example.com", "net", "q.net", "example.org", "com", "", "com.", ".com", "u@example.com:80"]
    paths = ["", "/", "/en/", "/en/x", "/en", "/es/1?q=/fr/", "/fr/#a", "?x", "#y", "/EN/"]
    urls = [None, "", "nothing", "http:/x", *(f"http://{h}{p}" for h in hosts for p in paths), "x://y://example.com/en/", "https://example.com/en/\nb"]
    rows = spark.createDataFrame([(i, u, "clash", "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, key string, host string, rule string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    for most in (100, 2):
        got = {r[0]: tuple(r)[1:] for r in filter_urls(rows.repartition(3), rules, max_rules=most).collect()}
        assert got == {i: brute_rule(u, RULES) for i, u in enumerate(urls)}
    assert {r.verdict for r in filter_urls(rows, rules.limit(0), default="block").collect()} == {"block"}
    assert filter_urls(rows.limit(0), rules).count() == 0
