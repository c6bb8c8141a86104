"""Array and text primitives against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import encodings, mixing, packing, partenum, prose, sample, segments
from corpusmill.llm.blocks import text_chunks
from corpusmill.llm.shingles import shingle_sets, word_hashes

WORD = re.compile(r"[^\W_]+")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.sampled_from(["İstanbul ΣΑΣ", "a_b", "x²½", "\n\n", "日本 語"])), max_size=6))
def test_words_are_runs_of_letters_and_digits(texts):
    hashes, offsets = word_hashes(texts)
    words = [WORD.findall((t or "").lower()) for t in texts]
    assert np.diff(offsets).tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len(set(flat)) == len(set(hashes.tolist()))
    by_word: dict = {}
    assert all(by_word.setdefault(w, h) == h for w, h in zip(flat, hashes.tolist()))


def test_shingle_sets_of_brute_force():
    r = random.Random(1)
    texts = [" ".join(r.choices("abcd", k=r.randrange(0, 30))) for _ in range(60)] + [None, "", "a"]
    hashes, ends, words = shingle_sets(texts, 3)
    for i, text in enumerate(texts):
        ws = (text or "").split()
        assert words[i] == len(ws)
        assert ends[i + 1] - ends[i] == len({tuple(ws[k : k + 3]) for k in range(len(ws) - 2)})
        assert (np.diff(hashes[ends[i] : ends[i + 1]].astype(object)) > 0).all()


def test_long_texts_go_block_by_block(monkeypatch):
    r = random.Random(3)
    texts = ["".join(r.choices("aé9 \n日_", k=n)) for n in (0, 5, 400, 3000)] + [None, "x" * 500]
    whole = word_hashes(texts)
    monkeypatch.setattr("corpusmill.llm.shingles.BLOCK_CHARS", 64)
    blocks = word_hashes(texts)
    assert (whole[0] == blocks[0]).all() and (whole[1] == blocks[1]).all()


def test_chunks_cover_all_texts():
    texts = ["a" * n for n in (5, 0, 300, 5, 5)] + [None]
    assert [i for a, b in text_chunks(texts, 10) for i in range(a, b)] == list(range(6))
    assert list(text_chunks([], 10)) == []


def test_similar_sets_share_a_signature():
    r = random.Random(4)
    missed = pairs = 0
    for size in (18, 25, 40, 80, 150, 400, 1500, 6000):
        for _ in range(12):
            base = np.array(r.sample(range(1 << 62), size), np.uint64)
            other = base.copy()
            # the share of replaced elements at which likeness is just above 0.66
            change = max(1, int(size * 0.2)) if size > 20 else 3
            other[:change] = np.array(r.sample(range(1 << 62), change), np.uint64)
            likeness = (size - change) / (size + change)
            if likeness < 0.66:
                continue
            pairs += 1
            sets = [np.sort(base), np.sort(other)]
            found, owner = partenum.signatures(np.concatenate(sets), np.array([0, size, 2 * size]), np.zeros(partenum.SLOTS, bool), 0.6)
            missed += not set(found[owner == 0].tolist()) & set(found[owner == 1].tolist())
    assert pairs > 60 and missed <= pairs // 50


def test_sets_of_frequent_shingles_still_have_signatures():
    base = np.sort(np.array(random.Random(2).sample(range(1 << 62), 60), np.uint64))
    found, owner = partenum.signatures(np.concatenate([base, base]), np.array([0, 60, 120]), np.ones(partenum.SLOTS, bool), 0.6)
    assert set(found[owner == 0].tolist()) == set(found[owner == 1].tolist()) and len(found)
    assert len(partenum.signatures(np.zeros(0, np.uint64), np.array([0, 0]), np.ones(partenum.SLOTS, bool), 0.6)[0]) == 0


def test_size_bands_hold_similar_sets_together():
    low, high = partenum.size_bands(5000, 0.6)
    for a in range(1, 3000, 7):
        band_a, band_b = (np.searchsorted(low, n, "right") for n in (a, int(a / 0.6)))
        assert band_b - band_a <= 1


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14), st.lists(st.integers(0, 3), max_size=14), st.integers(0, 9))
def test_banded_distance_of_brute_force(a, b, most):
    wanted = edit_distance(a, b)
    assert segments.word_distance(np.array(a, np.uint64), np.array(b, np.uint64), most) == (wanted if wanted <= most else None)


def test_edited_texts_share_segments():
    r = random.Random(6)
    loads = np.zeros(1 << 16, np.int64)
    missed = 0
    for size in (20, 30, 60, 120, 400):
        for _ in range(20):
            words = [f"w{r.randrange(10**6)}" for _ in range(size)]
            other = list(words)
            for _ in range(max(1, size // 20)):
                other[r.randrange(size)] = "changed"
            values, ends, counts = segments.windows([" ".join(words), " ".join(other)])
            ranks = segments.window_ranks(values, loads, 1 << 40)
            asked = segments.evaluation_keys(values[: ends[1]], ranks[: ends[1]], counts[0])
            held = segments.training_keys(values[ends[1] :], ranks[ends[1] :], counts[1], 0.6)
            missed += len(set(asked.tolist()) & set(held.tolist())) < segments.needed(len(asked))
    assert missed == 0


def test_feistel_permutation_is_one_to_one_and_even():
    ids = [*range(-2000, 60_000), 2**63 - 1, -(2**63), 2**40]
    values = [sample.permute(i) for i in ids]
    assert len(set(values)) == len(ids)
    for rate in (0.01, 0.1, 0.5):
        bound = sample.threshold(rate)
        hit = sum(v < bound for v in values)
        assert abs(hit - rate * len(ids)) < 5 * (rate * (1 - rate) * len(ids)) ** 0.5
        strided = [sample.permute(i * 1000) < bound for i in range(20_000)]
        assert abs(sum(strided) - rate * 20_000) < 5 * (rate * (1 - rate) * 20_000) ** 0.5
    assert sample.threshold(0) == 0 and sample.threshold(1) == 2**64
    with pytest.raises(ValueError):
        sample.threshold(1.5)


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_keeps_every_constraint(score):
    r = random.Random(8)
    sizes = np.array([r.choice([r.randrange(1, 100), r.randrange(1, 1001), 1000, 1]) for _ in range(800)])
    places = packing.best_fit(sizes, 1000, 12, None, score)
    assert max(np.bincount(places, sizes)) <= 1000 and max(np.bincount(places)) <= 12
    least = max(-(-sizes.sum() // 1000), -(-len(sizes) // 12))
    assert places.max() + 1 <= least * 1.1 + 1
    tight = packing.best_fit(sizes, 1000, 800, 1_200_000.0, score)
    assert max(np.bincount(tight, sizes.astype(float) ** 2)) <= 1_200_000 * (1 + 1e-9)
    assert packing.best_fit(np.array([]), 10).tolist() == []
    with pytest.raises(ValueError):
        packing.best_fit(np.array([11]), 10)


def test_raking_meets_margins():
    present = np.array([100.0, 300, 50, 50])
    source, topic = np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])
    uses = mixing.rake(present, [(source, np.array([200.0, 80])), (topic, np.array([110.0, 170]))], np.array([4.0] * 4))
    assert np.bincount(source, present * uses) == pytest.approx([200, 80])
    assert np.bincount(topic, present * uses) == pytest.approx([110, 170], rel=1e-3)
    capped = mixing.rake(present, [(source, np.array([200.0, 80])), (topic, np.array([10.0, 270]))], np.array([1.0] * 4))
    assert capped.max() <= 1 + 1e-9 and np.bincount(source, present * capped) == pytest.approx([200, 80])


def test_mix_plan_takes_the_largest_feasible_size():
    cells = [("a", "en", "x", 1000), ("b", "en", "x", 100), ("c", "en", "x", 999)]
    plan = mixing.mix_plan(cells, [("a", 0.5, 1), ("b", 0.4, 2), ("gone", 0.1, 1), (None, 0.3, 1), ("z", None, 1)])
    tokens = {p[0]: p[3] * dict((c[0], c[3]) for c in cells)[p[0]] for p in plan}
    assert tokens == pytest.approx({"a": 250, "b": 200})
    assert mixing.mix_plan([], [("a", 0.5, 1)]) == []


SENTENCES = {
    "en": """The river was moved to the north because the old mill had failed, and about forty people visit it each year.
        In the winter of the same year the bridge was closed, but the people of the town went on with the work.
        It is known for the market that was held in the square, and for the songs which are sung there.
        The council of the village had asked for a new road, although the money for it was not there.
        Some of the houses near the lake were built by the men who had worked in the mine.
        When the war was over, the school was opened again and the children came back to it.""",
    "de": """Der Fluss ist nicht weit von der Stadt und die Leute sind oft dort, weil es im Sommer ruhig ist.
        Die alte Mühle wurde in der Zeit nach dem Krieg von den Bauern gebaut und ist noch zu sehen.
        In der Mitte des Dorfes steht die Kirche, die mit dem Turm und den Glocken bekannt wurde.
        Als der Markt auf den Platz kam, war die Straße zu eng und der Rat ließ sie neu bauen.
        Es gibt in den Bergen viele Wege, und die meisten von ihnen sind auch im Winter offen.
        Der Name kommt von einem Wort, das in der alten Sprache so viel wie Wiese bedeutet.""",
}
STRANGE = {
    "it": "Il fiume scorre a nord della città e ogni anno molte persone vanno a vedere il vecchio mulino, che fu costruito dopo la guerra.",
    "nl": "De rivier loopt ten noorden van de stad en elk jaar komen er veel mensen kijken naar de oude molen, die na de oorlog werd gebouwd.",
    "fi": "Joki virtaa kaupungin pohjoispuolella, ja joka vuosi monet ihmiset käyvät katsomassa vanhaa myllyä, joka rakennettiin sodan jälkeen.",
    "zh": "这条河流经城市的北部，每年都有许多人来参观战后建造的旧磨坊。镇上的人们说，那里的市场曾经非常有名。",
    "ar": "يجري النهر شمال المدينة، وفي كل عام يأتي كثير من الناس لرؤية الطاحونة القديمة التي بنيت بعد الحرب.",
}


def prose_of(code, count, seed=0):
    """Texts of some sentences in any order; every eighth is a list."""
    r = random.Random(seed)
    sentences = [line.strip() for line in SENTENCES[code].split("\n")]
    words = [w.strip(".,") for line in sentences for w in line.split() if len(w) > 5]
    lists = ["\n".join(f"{r.choice(words)} {r.choice(words)}" for _ in range(14)) for _ in range(count // 8)]
    return [" ".join(r.sample(sentences, 4)) for _ in range(count)] + lists


@pytest.fixture(scope="module")
def learnt():
    return [prose.fit(code, prose_of(code, 160)) for code in SENTENCES]


def test_profiles_tell_prose_from_the_rest(learnt):
    english = "The river was moved to the north because the old mill had failed, and about forty people visit it each year."
    texts = [english, "\n".join(f"Name{i} place | {i} | {i * 7}" for i in range(9)), "#### ---- ****", "", None, "  \n", english.upper(), english.replace(" ", "\n", 3),
             "\n".join(f"https://img.example/{i:06x}/{i}" for i in range(8)), f"{english}\n1, 2, 3"]
    got = prose.measure(texts, ["en"] * len(texts), learnt)
    assert [p == 0 for p in got["profile"]] == [True, False, False, False, False, False, True, True, False, True]
    assert got["profile"][3] == got["profile"][4] == got["profile"][5] == -1
    assert got["words"][0] == len(english.split()) and got["closed_line_share"][0] == 1 and got["prose_share"][3] == 0
    guessed = prose.measure(["Der Fluss ist nicht weit von der Stadt und die Leute sind oft dort", english, english], [None, "xx", None], learnt)
    assert guessed["language"].tolist() == [1, -1, 0]
    assert prose.divergence(np.array([[1.0, 0]]), np.array([0, 1.0])) == pytest.approx([1.0])
    assert prose.divergence(np.array([[0.5, 0.5]]), np.array([0.5, 0.5])) == pytest.approx([0.0])


def test_held_out_prose_lists_and_words_in_no_order(learnt):
    r = random.Random(4)
    for number, code in enumerate(SENTENCES):
        held = prose_of(code, 80, seed=9)
        whole, lists = held[:80], held[80:]
        salad = []
        for text in whole:
            ws = text.split()
            r.shuffle(ws)
            salad.append(" ".join(ws))
        got = [prose.measure(part, [code] * len(part), learnt)["profile"] for part in (whole, lists, salad)]
        assert (got[0] == 0).all() and (got[1] == prose.OUTCOMES.index("list")).all() and (got[2] == prose.OUTCOMES.index("salad")).mean() > 0.95
    assert prose.fit("en", prose_of("en", 20)[:20]) is None


@pytest.mark.parametrize("code", STRANGE)
def test_prose_of_a_language_that_was_not_learnt_is_prose(learnt, code):
    text = STRANGE[code]
    for model in ([], learnt):
        got = prose.measure([text, f"{text}\n{text}", "\n".join(text.split()[:9]), "\n".join(f"{w} | {i * 17} | {i}" for i, w in enumerate(text.split() if code != "zh" else text))], [code] * 4, model)
        assert got["profile"][:2].tolist() == [0, 0] and got["profile"][3] > 0
        assert code == "zh" or got["profile"][2] > 0


SOUND = {
    "fr": "Le café situé près de la forêt protège une dorée bibliothèque élevée et l’île déjà célèbre où naît l’été",
    "ru": "Старая школа была перенесена потому что общая башня сгорела вдоль реки",
    "el": "Η σπάνια λίμνη της πόλης διασχίζει την αρχαία βιβλιοθήκη κοντά στην μονή",
    "pl": "Później łąka została przeniesiona, bo źródło spłonęło; główna wieś leży koło zamku i służy żyznej gęsi",
}


@pytest.fixture(scope="module")
def mender():
    from collections import Counter

    from corpusmill.llm import garbled

    r = random.Random(0)
    texts = [" ".join(r.sample(t.split(), len(t.split()) * 3 // 4)) for t in SOUND.values() for _ in range(50)] + [None, "", "plain"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    rows = next(garbled.count_characters(iter([batch])))
    counts = list(zip(*(c.to_pylist() for c in rows.columns)))
    assert Counter(k for k, _, _ in counts)["n"] == 3
    return encodings.Mender(encodings.CharacterModel(*garbled.character_model(counts)))


@pytest.mark.parametrize("lang", SOUND)
def test_sound_texts_are_left_alone(mender, lang):
    assert mender.examine(SOUND[lang], True) == (False, SOUND[lang])


@pytest.mark.parametrize(
    "lang, write, read",
    [("fr", "utf_8", "cp1252"), ("fr", "utf_8", "iso8859_1"), ("fr", "mac_roman", "cp1252"), ("ru", "utf_8", "cp1251"), ("ru", "cp1251", "cp1252"), ("ru", "koi8_r", "cp1252"),
     ("ru", "utf_8", "cp437"), ("el", "utf_8", "cp1252"), ("el", "cp1253", "cp1252"), ("pl", "utf_8", "cp1252"), ("pl", "cp1250", "cp1252")],
)
def test_garbled_texts_are_found_and_mended(mender, lang, write, read):
    table = encodings.decoding(read)
    broken = "".join(table[b] for b in SOUND[lang].encode(write, "ignore"))
    found, mended = mender.examine(broken, True)
    assert found and mender.examine(broken)[0]
    wanted = SOUND[lang].encode(write, "ignore").decode(write)
    same = sum(a == b for a, b in zip(mended.split(), wanted.split()))
    assert same >= 0.8 * len(wanted.split()), mended


def test_twice_and_partly_garbled(mender):
    table = encodings.decoding("cp1252")
    once = "".join(table[b] for b in "situé près".encode())
    twice = "".join(table[b] for b in once.encode())
    text = f"Le café déjà célèbre {twice} de la forêt"
    assert mender.examine(text, True) == (True, "Le café déjà célèbre situé près de la forêt")


def test_lost_characters_are_found_and_citations_are_not(mender):
    assert mender.examine("La forêt est situ� près", True)[0]
    for text in ("The mark “�” stands for an unknown character", "Ein Brief nennt das Zeichen „Ã¼“ statt ü", "On screens the sign showed up as ‘â‚¬’ once"):
        assert not mender.examine(text)[0], text
    for text in ("", "plain", "👩‍🔬🚀", "«»—"):
        assert mender.examine(text, True) == (False, text)
