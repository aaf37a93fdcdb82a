import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymill.functions.text import fold, squeeze, words
from tallymill.llm import copies, leaks, near, pairs, personal, sentences, tokenize, varied

LOG = "line_no bigint, q string, a string, channel string, rid string, sk string, text string"


def log(spark, qa):
    return spark.createDataFrame([(i, q, a, "c" if i % 3 else None, "clash", "clash", "clash") for i, (q, a) in enumerate(qa, 1)], LOG)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---------------------------------------------------------------- copies (problem 2)
COPIES = [
    ("Le débit ? OK.", "Oui : 12 %"),
    ("LE DÉBIT OK", "oui 12"),
    ("le­ débit, ok!", " Oui 12 "),
    ('{"a": "1", "b": "x y"}', "z"),
    ("b : x y ; a : 1", "Z."),
    ("A = 1\nB = X-Y", "z"),
    ("a: 1 | c: x y", "z"),
    (None, None),
    ("", " … "),
    (None, "z"),
    ("ab", "c"),
    ("ba", "c"),
]


def test_copies_groups(spark):
    got = rows(copies.found_copies(log(spark, COPIES)))
    assert got == [(1, 2), (1, 3), (4, 5), (4, 6), (8, 9)]
    kept = dict(rows(copies.collapse_copies(log(spark, COPIES))))
    assert kept == {1: 3, 4: 3, 7: 1, 8: 2, 10: 1, 11: 1, 12: 1}
    assert rows(copies.found_copies(log(spark, COPIES).limit(0))) == []


def test_a_hot_copy_group(spark):
    qa = [("same text", "same")] * 400 + [(f"t {i}", "x" * 3000) for i in range(50)]
    assert len(rows(copies.found_copies(log(spark, qa)))) == 399


@pytest.mark.parametrize("text,n", [("Note : a", None), ("no fields", None), ("a: 1; b: 2", 2), ('{"k": "v", "l": null}', 2), ("Précision : le débit, par heure, reste lent : oui", None), ("", None), (None, None)])
def test_named_fields(text, n):
    got = copies.named_fields(text)
    assert (got is None) if n is None else len(got) == n


# ---------------------------------------------------------------- near duplicates (problem 1)
def brute_groups(qa):
    sets = [set(words(fold((q or "") + " " + (a or "")))) for q, a in qa]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        if near.alike(len(sets[i] & sets[j]), len(sets[i]), len(sets[j])):
            parent[root(j)] = root(i)
    key = [copies.exchange_key(q, a)[0] for q, a in qa]
    return {(i + 1, j + 1) for i, j in itertools.combinations(range(len(sets)), 2) if root(i) == root(j) and sets[i] and key[i] != key[j]}


@pytest.mark.parametrize("seed,vocabulary,length", [(1, 30, 12), (2, 400, 25), (3, 12, 6)])
def test_near_groups_match_brute_force(spark, seed, vocabulary, length):
    rng = random.Random(seed)
    voc = [f"w{i}" for i in range(vocabulary)]
    qa = []
    for _ in range(60):
        base = [rng.choice(voc) for _ in range(rng.randint(1, length))]
        for _ in range(rng.randint(1, 4)):
            mine = [w if rng.random() > 0.12 else rng.choice(voc) for w in base]
            rng.shuffle(mine)
            cut = rng.randint(0, len(mine))
            qa.append((" ".join(mine[:cut]), " ".join(mine[cut:])))
    qa += [(None, None), ("", ""), ("solo", None)] + [qa[0]] * 30
    got = {tuple(r) for r in near.group_pairs(near.near_groups(log(spark, qa))).collect()}
    assert got == brute_groups(qa)


@pytest.mark.parametrize("small,medium", [(1, 1), (1, 1000), (1000, 1000)])
def test_near_blocks_of_each_size(spark, monkeypatch, small, medium):
    monkeypatch.setattr(near, "_SMALL", small)
    monkeypatch.setattr(near, "_MEDIUM", medium)
    test_near_groups_match_brute_force(spark, 5, 40, 15)


def test_near_empty_and_row_pairs(spark):
    none = log(spark, COPIES).limit(0)
    pair = "pair_id string, no_a bigint, no_b bigint, text_a string, text_b string, label string"
    t = spark.createDataFrame([("p", 1, 2, "a b c d", "a b c e d", None), ("p", 3, 4, "a b", "b a", None), ("p", 5, 6, None, "a", None), ("p", 7, 8, None, None, None), ("p", 9, 10, "a b c", "d e f", "x")], pair)
    assert rows(near.found_near(none, t)) == [("neardup_pairs", 1, 2)]


# ---------------------------------------------------------------- varied subset (problem 4)
def test_varied_subset(spark):
    qa = [(f"question about station number {i} and its own subject {i * 7}", "a") for i in range(300)] + [("the very same question asked again", "a")] * 300 + [(None, "a"), ("", "b")]
    df = log(spark, qa)
    got = varied.varied_subset(df, 60)
    lines = [r.line_no for r in got.collect()]
    assert len(lines) == len(set(lines)) == 60
    assert sum(300 < x <= 600 for x in lines) <= 8 and {r.channel for r in got.collect()} == {"", "c"}
    again = {r.line_no for r in varied.varied_subset(df.repartition(7), 60).collect()}
    assert again == set(lines)
    assert varied.varied_subset(df, 10_000).count() == len(qa) and varied.varied_subset(df.limit(0), 5).count() == 0


# ---------------------------------------------------------------- personal information (problem 5)
PII = [
    ("Mme Pollanier attend un appel au +33 6-39-98-81-87.", {("name", "Pollanier"), ("phone", "+33 6-39-98-81-87")}),
    ("Écrivez plutôt à remi.calier (at) sevtri-voirie.invalid pour la suite.", {("email", "remi.calier (at) sevtri-voirie.invalid")}),
    ("Contact : Karim Cordouon <sevier34@naumirposte [point] test>", {("name", "Karim Cordouon"), ("email", "sevier34@naumirposte [point] test")}),
    ("NIR : 2 56 06 99 000 757 30 - tél. 01 99 00 58 55", {("id_number", "2 56 06 99 000 757 30"), ("phone", "01 99 00 58 55")}),
    ("Le matériel est livré chez M. Barmann, 176 bis quai Ululpolgny - 00577 Ostgarola-Tolfel.", {("name", "Barmann"), ("address", "176 bis quai Ululpolgny - 00577 Ostgarola-Tolfel")}),
    ("I live at 50 Douulac Close, Velostquenwick-Garnol.", {("address", "50 Douulac Close, Velostquenwick-Garnol")}),
    ("Ask Ms Garard ((514) 555-0189) for the key.", {("name", "Garard"), ("phone", "(514) 555-0189")}),
    ("Mi documento es 00.163.614-S y vivo en Avenida Sevlirdal 137, 00502 Gripol.", {("id_number", "00.163.614-S"), ("address", "Avenida Sevlirdal 137, 00502 Gripol")}),
    ("Ich heiße Nadia Osttolier und wohne Ostfelouze-Zanbelstraße 160a, 00425 Vaupesmere.", {("name", "Nadia Osttolier"), ("address", "Ostfelouze-Zanbelstraße 160a, 00425 Vaupesmere")}),
    ("Le compteur 0690637898 indique 38. Consultez M@tériel au guichet 2067.", set()),
    ("La référence 5359 00 12 764 figure au plan. Le canal @supervision reste ouvert.", set()),
]


def test_personal_spans(spark):
    training = [t for t, _ in PII] * 12
    model = personal.fit(training)
    for text, want in PII:
        assert {(k, text[s:e]) for s, e, k in model.spans(text)} == want, text
    df = log(spark, [(PII[0][0], PII[0][0] + " " + PII[0][0]), (None, ""), ("rien", "x" * 20000)])
    assert len(rows(personal.find_personal(df, model))) == 4
    clean = rows(personal.redact_personal(df, model))
    assert clean[0][1] == "Mme [NAME] attend un appel au [PHONE]." and clean[1] == (2, None, "")
    assert rows(personal.find_personal(df.limit(0))) == []


def test_reliabilities_tell_good_from_bad_labelers():
    import numpy as np

    rng = np.random.default_rng(1)
    truth = rng.random(600) < 0.4
    votes = np.stack([np.where(rng.random(600) < p, np.where(truth, 1, -1), rng.integers(-1, 2, 600)) for p in (0.95, 0.9, 0.1)], axis=1)
    p, table = personal.em_reliability(votes)
    assert ((p > 0.5) == truth).mean() > 0.95 and table[1, 0, 2] > table[1, 2, 2]


# ---------------------------------------------------------------- broken pairs (problem 6)
def corpus():
    subjects = ["Le capteur de la station", "La carte des débits", "Le poste de pesage", "La boucle enfouie", "Le portail cartographique"]
    verbs = ["rejette les relevés tardifs", "sature pendant la pointe", "garde une ancienne limite", "masque les lacunes de données"]
    tails = ["faute de liaison cellulaire", "avant toute publication", "hors vacances scolaires", "ce qui reste à documenter"]
    rng = random.Random(4)
    say = lambda: f"{rng.choice(subjects)} {rng.choice(verbs)}, {rng.choice(tails)}."
    english = ["The map portal keeps an old limit with the new release, and we see this at the station."]
    out = [(f"Pourquoi {say().lower()}", say() + " " + say()) for _ in range(500)]
    out += [("Why does the sensor of the station saturate at peak time?", english[0]) for _ in range(60)]
    return out + [("Pourquoi la carte des débits sature ?", "Je regrette, je ne peux pas répondre à cette demande.") for _ in range(20)]


def test_defects(spark):
    judge = pairs.train_judge(corpus())
    q = "Pourquoi le capteur de la station rejette les relevés tardifs, faute de liaison cellulaire ?"
    good = "La carte des débits garde une ancienne limite, avant toute publication."
    cases = [
        ((q, None), "empty"),
        ((q, " … "), "empty"),
        ((q, good), None),
        ((q, good.rstrip(".")), None),
        ((q, good + " La boucle enfouie sature pendant la poi"), "truncated"),
        ((q, good + " (La boucle enfouie sature"), "truncated"),
        ((q, "Je regrette, je ne peux pas répondre à cette demande."), "refusal"),
        ((q, "Vous demandez : " + q), "copied"),
        ((q, q.upper()), "copied"),
        ((q, "The map portal keeps an old limit with the new release, and we see this at the station."), "other_language"),
        (("Merci de répondre en anglais : " + q, "The map portal keeps an old limit with the new release, and we see this at the station."), None),
        ((q, "文件需要重新校准在附近。流量地图拒绝迟到的读数。"), "other_language"),
        ((None, good), None),
        (("", good), None),
    ]
    for (x, y), want in cases:
        assert judge.defect(x, y) == want, (x, y)
    df = log(spark, [c[0] for c in cases])
    assert {r.line_no: r.defect for r in pairs.find_defects(df, judge).collect()} == {i: w for i, (_, w) in enumerate(cases, 1) if w}
    assert rows(pairs.find_defects(df.limit(0), judge)) == []


REFUSALS = """Je ne peux pas vous répondre|ici pas autorisé|je dois décliner|nous préférons refuser|je dois m'abstenir|je préfère ne pas|ne pas me prononcer|il m'est impossible|il nous est impossible
je refuse de traiter|cela sort de ce que je sais|cela ressort de ce que j'ai|droit d'aborder|Cette demande est hors de mon périmètre.|dehors de mon domaine|n'ai pas le droit|pas mon rôle|je me refuserai|dois refuser|un repas autorisé
I cannot|I can't|I can not|I won't|unable to|not able to|not allowed|not permitted|not authorized|not authorised|must decline|have to decline|decline to|rather not|prefer not|not comfortable|refuse to|outside what I|outside of what I
no puedo|no podemos|no estoy autorizada|bueno estoy autorizado|no me es posible|no tengo permitido|no me está permitido|prefiero no|debo rechazar|debo declinar|me es imposible|esto es fuera de lo que|afuera de lo que|no me corresponde|declino
das kann ich nicht|ich darf das nicht|muss ich ablehnen|muss ich ablehnend|ablehnen muss|nicht befugt|nicht berechtigt|nicht beantworten|nicht äußern|nicht erlaubt|nicht möglich|Das liegt außerhalb dessen, was hier geht.|AUSSERHALB bleibt: außerhalb dessen"""


@pytest.mark.parametrize("answer", REFUSALS.replace("\n", "|").split("|"))
def test_no_refusal_skips_the_field(answer):
    seen = []

    class Tags:
        def tag(self, x):
            seen.append(len(x))
            return [0] * len(x)

    assert pairs.REFUSAL.search(answer)
    pairs.PairJudge(Tags(), pairs.EndModel([])).defect(None, answer + (" ." if answer[-1] != "." else ""))
    assert seen


# ---------------------------------------------------------------- token ids (problem 7)
TEXTS = st.text(alphabet=st.sampled_from(list("abcdéàZ09 '’.,;!?\n\t-_€漢字ไทย🙂  ")), max_size=300)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=6))
def test_chunks_give_the_same_ids(texts):
    encoder = tokenize.ChunkEncoder()
    assert encoder.batch(texts) == [encoder.encode(t) for t in texts]


def test_token_ids_table(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "  "), (4, "don't stop '' '!'s it's"), (4, "don't stop '' '!'s it's"), (5, "mot " * 5000)], "doc_id bigint, text string")
    got = rows(tokenize.token_ids(docs))
    encode = tokenize.ChunkEncoder().encode
    assert got == sorted(((d, encode(t or "")) for d, t in rows(docs)), key=str)
    assert tokenize.token_ids(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- leaks (problem 8)
def test_leaks(spark):
    rng = random.Random(8)
    voc = [f"mot{i}" for i in range(900)]
    items = [(i, " ".join(rng.choice(voc) for _ in range(60))) for i in range(20)] + [(90, None), (91, ""), (92, "deux mots")]
    filler = lambda n: " ".join(rng.choice(voc) for _ in range(n))
    w = [t.split() for _, t in items[:20]]
    edited = w[3][:]
    edited[10] = edited[30] = edited[50] = "autre"
    docs = [
        (1, filler(80) + ". " + items[0][1].upper() + "! " + filler(40)),
        (2, filler(30) + " " + " ".join(w[1][:34]) + " " + filler(30)),
        (3, filler(30) + " " + " ".join(w[1][:20]) + " " + filler(90)),
        (4, " ".join(w[2][:18]) + " " + filler(60) + " " + " ".join(w[2][35:55])),
        (5, " ".join(edited)),
        (6, filler(400)),
        (7, None),
        (8, ""),
        (9, " ".join(reversed(w[4]))),
    ]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame([(a, b, "s") for a, b in items], "item_id bigint, text string, suite string")
    assert rows(leaks.found_leaks(d, i)) == [(0, 1), (1, 2), (2, 4), (3, 5)]
    assert rows(leaks.found_leaks(d.limit(0), i)) == [] and rows(leaks.found_leaks(d, i.limit(0))) == []


def test_a_leak_late_in_a_long_document(spark):
    rng = random.Random(9)
    voc = [f"mot{i}" for i in range(60)]
    item = [rng.choice(voc) for _ in range(100)]
    # wording of one trade: nearly every word lies near a trigram of the item, so the alignment gets them all
    trade = lambda n: [w for k in range(n // 10) for w in (lambda at: item[at : at + 3] + ["autre"] * 7)((k * 37) % 97)]
    docs = [(1, " ".join(trade(22_000) + item)), (2, " ".join(trade(45_000) + item[:30] + trade(25_000) + item[45:75])), (3, " ".join(trade(45_000)))]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame([(5, " ".join(item))], "item_id bigint, text string")
    assert rows(leaks.found_leaks(d, i)) == [(5, 1), (5, 2)]


@pytest.mark.parametrize("wide", [40, 4096])
def test_alignment_in_windows(monkeypatch, wide):
    import numpy as np

    rng = np.random.default_rng(wide)
    pairs_ = [(rng.integers(1, 12, rng.integers(5, 30)), rng.integers(1, 12, rng.integers(1, 900))) for _ in range(60)]
    want = [w[1:] for p in pairs_ for w in leaks._align_whole([p])]
    monkeypatch.setattr(leaks, "_WINDOW", wide)
    assert leaks._align(pairs_) == want
    a = np.arange(1, 101)
    assert leaks._align([(a, np.concatenate([np.zeros(30_000, dtype=np.int64), a]))]) == [(100, 0, 100, 30_000, 30_100)]


# ---------------------------------------------------------------- sentences (problem 9)
SENTENCES = [
    ("M. Douier a relevé env. 32,7 km de bouchon. Voir p. ex. la fiche n° 12, cf. annexe 8.", ["M. Douier a relevé env. 32,7 km de bouchon.", "Voir p. ex. la fiche n° 12, cf. annexe 8."]),
    ("« La station est muette ! » a prévenu l'opérateur. Qui a coupé la D66 à 10 h ?! Rien.", ["« La station est muette ! » a prévenu l'opérateur.", "Qui a coupé la D66 à 10 h ?!", "Rien."]),
    ("Mme Tritanot répond : « Le câble est changé. » Pour mémoire, rien.", ["Mme Tritanot répond : « Le câble est changé. »", "Pour mémoire, rien."]),
    ("Bilan de X\n\nLe tube posé\nvers Y reste. iComptage relit a.csv.\n\n1. un\n2) deux\n- trois", ["Bilan de X", "Le tube posé\nvers Y reste.", "iComptage relit a.csv.", "1. un", "2) deux", "- trois"]),
    ("— Qui ?\n— Moi. Toi.", ["— Qui ?", "— Moi.", "Toi."]),
    ('Dr. V said, "It is done." Then 12 left. See e.g. No. 3.', ['Dr. V said, "It is done."', "Then 12 left.", "See e.g. No. 3."]),
    ("Am 2. Juni stieg es. Siehe z. B. Blatt Nr. 3, vgl. S. 113, zu Xanten. Es fehlen Reifen usw. Wir sehen.", ["Am 2. Juni stieg es.", "Siehe z. B. Blatt Nr. 3, vgl. S. 113, zu Xanten.", "Es fehlen Reifen usw.", "Wir sehen."]),
    ("«Станция молчит!» — предупредил оператор. В 2022 г. поток вырос. Шины и т. д. Кто?", ["«Станция молчит!» — предупредил оператор.", "В 2022 г. поток вырос.", "Шины и т. д.", "Кто?"]),
    ("他问“谁关闭了？”并记下了。对吗？请检查……再重启！", ["他问“谁关闭了？”并记下了。", "对吗？", "请检查……再重启！"]),
    ("「誰か。」と尋ねた。版9.9.9のみ（9頁参照）。", ["「誰か。」と尋ねた。", "版9.9.9のみ（9頁参照）。"]),
    ("डॉ. वर्णिल ने कहा। क्या? हाँ।", ["डॉ. वर्णिल ने कहा।", "क्या?", "हाँ।"]),
    ("أكد د. سالم أن الإصدار صالح. من أغلق؟", ["أكد د. سالم أن الإصدار صالح.", "من أغلق؟"]),
    ("แบบจำลอง763 ปริมาณรถ", ["แบบจำลอง763", "ปริมาณรถ"]),
    ('{"st": "A", "q": [1]}\n\nSELECT * FROM t WHERE a > 1.5\nA\t1\t2', ['{"st": "A", "q": [1]}', "SELECT * FROM t WHERE a > 1.5", "A\t1\t2"]),
    ("", []),
    (" \n\t", []),
    (None, []),
]


@pytest.mark.parametrize("text,want", SENTENCES)
def test_sentence_units(text, want):
    got, a = [], 0
    for e in sentences.sentence_ends(text):
        got.append(text[a:e].strip())
        a = e
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abC .!?…\n\t—-«»\"“”()1。「」ไ")), max_size=80))
def test_units_cover_every_sign(text):
    ends = sentences.sentence_ends(text)
    assert ends == sorted(set(ends)) and (not ends) == (not text.strip())
    if ends:
        assert ends[-1] == len(text.rstrip()) and all(not text[e - 1].isspace() for e in ends)


def test_sentence_table(spark):
    docs = spark.createDataFrame([(1, "Aa bb. Cc dd."), (2, None), (3, ""), (1, "Aa bb. Cc dd."), (4, "Mot mot. " * 3000)], "doc_id bigint, text string")
    got = sentences.sentence_units(docs)
    assert got.count() == 3004 and got.where("doc_id IN (2, 3)").count() == 0
    assert squeeze("a b") == "ab"


@pytest.mark.parametrize("name", ["byte_bpe_50k", "byte_bpe_multi_50k"])
def test_joins_of_chunks_are_repaired(name, monkeypatch):
    import random

    rng = random.Random(5)
    parts = ["don't", " I'll", "  ", "\n\n", "ab" * 40, "12345", "٣٤", "été", "日本語テキスト", "...", "!?'s", " 'tis", "ไทย", " ", "é", "🙂", "x", " ", "'", "''ve", "\ud800"]
    for bits in (1, 2, 4, 8):
        monkeypatch.setattr(tokenize, "CUT_BITS", bits)
        encoder = tokenize.ChunkEncoder(name=name)
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(300)] + [None, "", " ", "a" * 5000]
        texts += texts[:50]
        assert encoder.batch(texts) == [encoder.encode(t) if t else [] for t in texts]
        assert encoder.widened == 0
        if bits == 4:
            assert encoder.encoded < encoder.met
    assert encoder._repair("abc", encoder.encode("zz"), []) is None


def test_a_join_that_disagrees_takes_the_whole_text(monkeypatch):
    monkeypatch.setattr(tokenize, "CUT_BITS", 5)
    encoder = tokenize.ChunkEncoder()
    monkeypatch.setattr(encoder, "_repair", lambda *_: None)
    text = "One two, three: four five; six seven. " * 20
    assert encoder.ids(text) == encoder.encode(text) and encoder.widened == 1


def test_spans_equal_the_quadratic_programme(monkeypatch):
    monkeypatch.setattr(sentences, "LONG", 16)
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randint(1, 12)
        starts = sorted(rng.sample(range(60), n + 1))
        scores = [rng.uniform(-4, 4) for _ in range(n)]
        state = [rng.choice(("a", "b")) for _ in range(n + 1)]
        weights = sentences.Weights(length=[rng.uniform(-2, 2) for _ in range(6)])
        got = sentences._best_spans(starts, scores, state, weights)

        def value(ends):
            return sum(scores[j - 1] + weights.span(starts[j] - starts[i]) - 6.0 * (state[i] != state[j]) for i, j in zip([0, *ends], ends))

        every = [[*inner, n] for k in range(n) for inner in itertools.combinations(range(1, n), k)]
        assert abs(value(got) - max(map(value, every))) < 1e-9


def test_long_runs_take_linear_time():
    import time

    text = "Il pleut. Ok ! (Un. Deux.) " * 40_000
    began = time.perf_counter()
    assert len(sentences.sentence_ends(text)) > 100_000
    assert time.perf_counter() - began < 60


def test_words_and_lengths_weigh():
    weights = sentences.fit_weights(["Le comptage de la rue, fait avec M. Dupont, est fini. Il reste la voie. On reprend demain matin avec M. Petit. Merci."] * 30)
    assert any(weights.length) and weights.first and weights.last
    assert sentences.sentence_ends("Vu. Su.", sentences.Weights(first={"su": -9.0})) == [7]
    assert sentences.sentence_ends("Un café (au กาแฟ) is good. Yes.") == [26, 31]  # one Thai word makes no Thai text


def test_weights_come_from_every_document(spark):
    rng = random.Random(3)
    say = lambda: rng.choice(("La boucle compte mal.", "Elle attend M. Petit à Lyon.", "On reprend demain, dit M. Dupont, avec elle.", "Les voies sont 3. La file est lente."))
    texts = [" ".join(say() for _ in range(rng.randint(1, 6))) for _ in range(2500)]
    table = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id bigint, text string")
    want = sentences.fit_weights(texts)
    for t in (table, table.repartition(7, "text")):
        got = sentences.weights_of(t)
        assert (got.first, got.last, got.length) == (want.first, want.last, want.length)
    assert any(0 < abs(x) < 0.75 for x in [*want.first.values(), *want.last.values(), *want.length])


def test_leaks_with_edits_accents_and_short_items(spark):
    rng = random.Random(18)
    voc = [f"mot{i}" for i in range(900)]
    usual = " ".join(rng.choices(voc, k=6))
    items, docs = [], []
    for i in range(40):
        words_ = rng.choices(voc, k=rng.randint(60, 140))
        items.append((i, " ".join(words_)))
        every = [f"autre{rng.randint(0, 999)}" if j % 4 == 3 else w for j, w in enumerate(words_)]
        docs.append((i, " ".join(rng.choices(voc, k=50) + every + rng.choices(voc, k=50))))
    items += [(100, "resume du cafe de la gare"), (101, "été çà là"), (102, None), (103, " "), (104, "seul")]
    docs += [(100, "Résumé du café de la gare."), (101, "ete ca la"), (102, None), (103, ""), (104, "seul"), (105, (usual + " ") * 900 + items[0][1])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = set(rows(leaks.found_leaks(d, spark.createDataFrame(items, "item_id bigint, text string"))))
    assert {(i, i) for i in (*range(40), 100, 101)} | {(0, 105)} <= got
    assert not {p for p in got if p[0] in (102, 103, 104)}
    assert leaks.found_leaks(d.limit(0), spark.createDataFrame(items, "item_id bigint, text string")).count() == 0


def test_names_on_no_list_and_any_ending():
    given = ["Karim", "Claire", "Hugo", "Marta", "Emma", "Sven"]
    family = ["Lanmorel", "Velpolot", "Dimfauau", "Ostsolmann", "Calnolsby", "Corvelez"]
    rng = random.Random(1)
    texts = []
    for _ in range(120):
        who = f"{rng.choice(given)} {rng.choice(family)}"
        texts += [f"Merci de rappeler {who} au 06 39 98 20 47.", f"My name is {who}, reach me at x{rng.randint(1, 99)}@tal.example.", f"Cordialement, {who}", f"Mme {who.split()[1]} attend un appel.", f"Le comptage de la rue {who} est faux.", f"La station {who.split()[1]}ville reste stable."]
    model = personal.fit(sorted(set(texts)))
    want = {
        "Contact: Mr. Okafor asap": "Okafor", "Bonjour Mme Nguyen, merci": "Nguyen", "ask Mr Smith about it": "Smith", "Frau Schmidt hat angerufen": "Schmidt", "My name is Priya Sharma, call me": "Priya Sharma",
        "Regards,\nJohn Smith": "John Smith", "меня зовут Иван Петров": "Иван Петров", "contact 田中太郎 please": "田中太郎", "Merci de rappeler Bukola Adeyemi au 06 39 98 20 47.": "Bukola Adeyemi",
        "Cordialement, Ravi Vanderbilt": "Ravi Vanderbilt", "Ich heiße Mbali Ricci und komme.": "Mbali Ricci",
    }
    for text, name in want.items():
        assert name in {text[a:b] for a, b, k in model.spans(text) if k == "name"}, text
    assert [(k, "anna.kowal@firma.pl und noch"[a:b]) for a, b, k in model.spans("anna.kowal@firma.pl und noch")] == [("email", "anna.kowal@firma.pl")]
    assert not model.spans("CALLOUZANDAL DÉCALE LES CRÉNEAUX") and not model.spans("")


def test_wordings_of_refusal_and_order_of_rows(spark):
    clean = [(f"Combien de véhicules compte la boucle {i} du pont ?", f"La boucle {i} du pont compte {i * 37} véhicules par jour, dont {i} camions.") for i in range(60)]
    told = [("¿Cuántos coches cuenta el lazo?", "Lo siento, no tengo permiso para hablar de Callouola."), ("Wie viele Autos zählt die Schleife?", "Zu Lanpolgny darf ich keine Auskunft geben.")]
    table = log(spark, clean + told)
    got = rows(pairs.find_defects(table))
    assert {(61, "refusal"), (62, "refusal")} <= set(got)
    assert rows(pairs.find_defects(table.repartition(7, "q"))) == got
    judge = pairs.judge_on(table)
    assert all(judge.defect(q, a) == judge.defect(q, a, every=True) for q, a in clean + told)


@pytest.mark.parametrize("answer", [*REFUSALS.replace("\n", "|").split("|"), "NO ME ESTÁ PERMİTIDO", "I am not permıtted", "La boucle du pont compte.", ""])
def test_refusals_are_told_by_their_own_words(answer, monkeypatch):
    said = bool(pairs.REFUSAL.search(answer))
    assert pairs.declines(answer, fold(answer)) == said
    if not said:  # patterns cost most of the judge's time: without their words none is tried
        monkeypatch.setattr(pairs, "_REFUSED", tuple((ws, None) for ws, _ in pairs._REFUSED))
        assert not pairs.declines(answer, fold(answer))


def test_the_judge_is_fitted_on_every_row(spark):
    rng = random.Random(8)
    say = lambda: f"La boucle {rng.randint(1, 99)} du pont compte {rng.choice(('mal', 'bien', 'trop'))} les {rng.choice(('camions', 'bus', 'motos'))}."
    qa = [(f"Pourquoi {say().lower()[:-1]} ?", " ".join(say() for _ in range(1 + i % 3))) for i in range(6000)]
    qa += [("Et la file ?", "Elle est lente, vu le zénith.")] * 7 + [("Et la file ?", " ".join("Elle est lente." for _ in range(30))), (None, None)]
    want = pairs.train_judge(qa)
    for table in (log(spark, qa), log(spark, qa).repartition(7, "a")):
        got = pairs.judge_on(table)
        assert got.ends.vocabulary == want.ends.vocabulary and got.ends.grams == want.ends.grams
        assert (got.field.w == want.field.w).all() and (got.field.t == want.field.t).all()
    assert len(pairs._example(b"c", pairs.np.zeros((30, pairs.N_FEATURES)), [0] * 30)) == 3  # long answers are kept whole


def test_subset_with_more_channels_than_places(spark):
    table = spark.createDataFrame([(i, f"Question {i} sur la boucle {i % 17} ?", "x", f"canal {i % 30 if i % 2 else 0}", "c", "c", "c") for i in range(900)], LOG)
    got = rows(varied.varied_subset(table, 10))
    assert len(got) == 10 and len({c for _, c, _ in got}) == 10 and any(c == "canal0" for _, c, _ in got)
    some = rows(varied.varied_subset(table, 200))
    assert len(some) == 200 and len({c for _, c, _ in some}) == 16
    assert rows(varied.varied_subset(table.repartition(9, "q"), 200)) == some
    assert len(rows(varied.varied_subset(table, 5000))) == 900


def test_blocks_in_shards_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near, "_BLOCK", 7)
    rng = random.Random(12)
    base = [" ".join(rng.choices("abcdefghijklmnop", k=1)[0] + str(rng.randint(0, 3)) for _ in range(8)) for _ in range(60)]
    texts = base + [b.replace(b.split()[0], "x9") for b in base]
    sets_ = [frozenset(t.split()) for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i) if sets_[i] != sets_[j] and near.alike(len(sets_[i] & sets_[j]), len(sets_[i]), len(sets_[j]))}
    profiles = near.profiles_of(spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "line_no bigint, q string, a string"))
    key = {r.rid: r.sk for r in profiles.collect()}
    got = {tuple(sorted(r)) for r in near.similar_sets(profiles).collect()}
    assert got == {tuple(sorted((key[i], key[j]))) for i, j in want} and got


@pytest.mark.parametrize("alike", [False, True])
def test_equal_stretches_lose_no_pair_of_a_large_block(monkeypatch, alike):
    np = near.np
    rng = np.random.default_rng(7)
    n = 1500
    s = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
    for i in range(0, n // 2, 2):  # a partner that differs in up to 12 bits
        flips = rng.integers(0, 128, rng.integers(1, 13))
        s[:, i + 1] = s[:, i]
        for k in flips:
            s[k // 64, i + 1] ^= np.uint64(1) << np.uint64(k % 64)
    if alike:
        s[:] = s[:, :1]
    slack, sk, rest = rng.integers(-200, 300, n), np.arange(n), np.full(n, 40)
    first = slack >= 0
    i, j = np.triu_indices(n, 1)
    want = {tuple(p) for p in near._near(s, slack, first, sk, i, j).T.tolist()}
    monkeypatch.setattr(near, "_LEVELS", ((4, 1), (7, 1), (9, 1)))
    monkeypatch.setattr(near, "_PROBE", 50)
    got = {tuple(p) for found in near._tiles(s, slack, rest, first, sk) for p in found.T.tolist()}
    assert got == want and len(want) > 50
    assert near._equal_stretches(s, slack, first, sk, 0, 4, []) is not alike  # by stretches, unless all are equal


def test_no_set_is_written_under_a_frequent_word_without_a_partner_in_reach():
    np, pa = near.np, near.pa
    rng = random.Random(3)
    sets_ = []
    for _ in range(120):  # words 0-9 are frequent, the others not
        base = {rng.randrange(100, 400) for _ in range(rng.randint(0, 9))} | set(rng.sample(range(10), rng.randint(3, 9)))
        sets_ += [base, base ^ {rng.randrange(10)}, base ^ {rng.randrange(100, 400)}]
    sets_ = sorted(set(map(frozenset, sets_)), key=sorted)
    toks = pa.array([sorted(x) for x in sets_], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sets_)), pa.int64()), toks], names=["sk", "toks"])
    hot, rank, one, every = np.arange(10, dtype=np.uint32), np.arange(10), np.ones(10, dtype=np.int64), np.full(1 << 19, ~np.uint64(0))
    top = np.full((10, near._FOLLOW), near._NONE, dtype=np.int64)
    for b in near._hot_prefixes(hot, rank)([batch]):
        k, f, _, most = (c.to_numpy() for c in b.columns)
        np.maximum.at(top, (k, f), most)

    def written(reach):
        columns = [np.concatenate(c) for c in zip(*([x.to_numpy() for x in b.columns] for b in near._prefixes(hot, rank, one, reach, every)([batch])))]
        order = np.argsort(columns[0], kind="stable")
        tok, meta, sk, *s = (c[order] for c in columns)
        found = near._blocks(tok, meta, sk, np.stack([x.view(np.uint64) for x in s])).T.tolist()
        return len(tok), {(a, b) for a, b in found if near.alike(len(sets_[a] & sets_[b]), len(sets_[a]), len(sets_[b]))}

    all_rows, want = written(np.full((10, near._FOLLOW), 1 << 40, dtype=np.int64))
    few_rows, got = written(near._reach(top))
    brute = {(a, b) for a, b in itertools.combinations(range(len(sets_)), 2) if near.alike(len(sets_[a] & sets_[b]), len(sets_[a]), len(sets_[b]))}
    assert got == want == brute and brute
    assert few_rows < all_rows


def test_pairs_are_looked_at_once_with_the_same_verdicts(spark, monkeypatch):
    qa = [(f"Pourquoi la boucle {i} de la station dérive-t-elle ?", f"La boucle {i} de la station sature en pointe. Le relevé suit.") for i in range(40)]
    qa += [("Et le débit ?", "Je ne peux pas répondre à cette question."), ("Et le débit ?", None), ("Et le débit ?", "The data of the loop is late and it was not sent by the station."), qa[0][:1] * 2]
    table = log(spark, qa)
    judge = pairs.judge_on(table)
    want = [(i, d) for i, (q, a) in enumerate(qa, 1) if (d := judge.defect(q, a))]
    assert rows(pairs.find_defects(table)) == sorted(want, key=str) and len(want) >= 2
    said = []
    monkeypatch.setattr(pairs, "declines", lambda text, *of: bool(said.append(text)))
    pair = pairs.Pair(*qa[0], judge.ends)
    pairs.examples(*qa[0], judge.ends, pair)
    assert pair.features is pair.features and len(said) == len(set(said))  # a clause that stands in the broken answer too is told once


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_words_by_pieces(text):
    text = pairs.visible(text)
    assert pairs._words_of(text) == words(fold(text))
    assert pairs._folded(text) == fold(text)


def test_runs_of_tokens_by_numbers(monkeypatch):
    rng = random.Random(5)
    odd = ["e.g.", "A.B", "..", "...", "…", "fin…", "Où?!", "l'eau", "STC-E12-3467", "a_b.csv", "٣٤", "ﬁn", "x​...", "co­de", " ", " ", "Élan-Vital,", "-ab-", "12,5", "12345678", "ǅ", "ı.", ":", ""]
    texts = [" ".join(rng.choice(odd + ["la", "Boucle", "du", "pont."] * 6) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    texts += ["LE DÉBIT 12 EST BAS.", "le débit 13 est bas.", "Le Débit 14 Est Bas.", "\n la boucle\tsuit ? oui \x1f non. "]
    ends = pairs.EndModel(vocabulary=frozenset({"la", "boucle", "du", "pont", "eau", "co"}))
    met, ended, seen = {}, {}, {}
    for t in texts:
        ends.count(pairs.visible(t), met, ended)
        for w in words(fold(t)):
            seen[w] = seen.get(w, 0) + 1
    batches = [pairs.pa.RecordBatch.from_arrays([pairs.pa.array(texts[a : a + 150])], names=["t"]) for a in range(0, len(texts), 150)]
    for held in (100_000, 20):  # 20: passed on often, and the longer texts counted alone
        monkeypatch.setattr(pairs, "_HELD", held)
        got, told = {}, {}
        for b in pairs._counted_runs(ends)(batches):
            for g, n, e in zip(*(c.to_pylist() for c in b.columns)):
                got[g] = got.get(g, 0) + n
                told[g] = told.get(g, 0) + e
        assert got == met and {g: e for g, e in told.items() if e} == ended
        found = {}
        for b in pairs._counted_words(batches):
            for w, n in zip(*(c.to_pylist() for c in b.columns)):
                found[w] = found.get(w, 0) + n
        assert found == {w: n for w, n in seen.items() if not w.isdigit()}
    monkeypatch.setattr(pairs, "_HELD", 100_000)
    made = []
    monkeypatch.setattr(pairs.EndModel, "_token", lambda self, w, mixed: made.append(w) or w)
    list(pairs._counted_runs(ends)([pairs.pa.RecordBatch.from_arrays([pairs.pa.array([f"Le {i} {k}." for i in range(10, 99) for k in range(100, 140)])], names=["t"])]))
    assert len(made) < 10  # numbers that differ in their digits alone are told once


PIECES = st.sampled_from(["La", "boucle", "pont.", "pont", "etc.", "M.", "7.", "Mai", "a)", "- b", "A.", "b;", "fin!", "Où?!", "'", "’", ".'", '"', "«", "»", "(", ")", "…", "...", "。", "終。次", "กข", "\n", "\t", "INFO", "SELECT", "é.", "№", "①", "é", "iOS", "¿Qué", "—", "3", "12.", "E.ON", "̸", "´", "゙", " ", "ı", "pas", "Mon"])


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(PIECES, st.sampled_from([" ", " ", " ", "", "  "])), max_size=14))
def test_units_of_a_plain_line_and_their_words(pieces):
    text = pairs.visible("".join(p + blank for p, blank in pieces))
    assert pairs._unit_ends(text) == sentences.sentence_ends(text)
    assert [w for p in pairs.clauses(text) for w in words(fold(p))] == words(fold(text))


def test_a_plain_answer_is_cut_without_spans(monkeypatch):
    monkeypatch.setattr(pairs, "sentence_ends", None)
    assert pairs.clauses("La boucle sature vers 10.30 avec M. Okafor. Le relevé suit; il est lu. ") == ["La boucle sature vers 10.30 avec M. Okafor.", "Le relevé suit", "il est lu."]


@pytest.mark.parametrize("answer", [*REFUSALS.replace("\n", "|").split("|"), "NO ME ESTÁ PERMİTIDO", "I am not permıtted", "Bien reçu", "merci de votre appel", "Désolé", "Es tut mir leid", "ha llegado", "lo siento", "it was received"])
def test_wording_is_held_by_a_piece(answer):
    for text in (answer, f"La boucle suit. {answer}, dit-on.", answer.replace(" ", " ")):
        text = pairs.visible(text)
        ws, pieces = pairs._read(text)
        assert ws == words(fold(text))
        if pairs.REFUSAL.search(text) or pairs.SOFTENER.search(text):
            assert not pairs._HOLDING.isdisjoint(pieces)
    assert pairs._HOLDING.isdisjoint(pairs._read("La table dépasse la mesure, hors vacances, à droite du passage.")[1])
