"""Chat windows, decontamination, secrets and pseudonyms on small cases."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayloom.llm import chat, decontaminate, pii, secrets
from stayloom.session import staged

CHAT = "conv_id long, turn long, role string, text string, tokens string, loss int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 0) for r in rows], CHAT).repartition(3)


def chat_rows():
    rng = np.random.default_rng(1)
    rows = [(1, 0, "system", "Be brief."), (2, 0, "user", None), (2, 1, "assistant", None), (3, None, None, "no role"),
            (3, 1, "assistant", "\\n <|im_end|>\n </s>[INST] a\\\\b [[INST]] <<SYS>> \\"), (3, 1, "a\\\nb<|im_start|>", "x"),
            (None, 5, "assistant", "lost"), (None, 4, "user", "<s>"), (4, 1, "assistant", "same"),
            (4, 1, "assistant", "same"), (4, 0, "system", "w " * 3000), (4, 2, "assistant", "é" * 5000), (5, 0, "user", "")]
    for k in range(1, 700):
        rows.append((1, k, "user" if k % 2 else "assistant", "word " * int(rng.integers(1, 120)) + str(k)))
    return rows


def test_chat_round_trip(spark):
    rows = chat_rows()
    windows = chat.chat_windows(conversations(spark, rows), budget=400, history_tokens=120)
    got = {r.conv_id: r for r in chat.conversation_digests(windows).collect()}
    assert len(got) == 6
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        target = "".join(x for _, _, r, x in turns if r == "assistant")
        row = got[conv]
        assert (row.n_turns, row.loss_chars) == (len(turns), len(target))
        assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(target.encode()).hexdigest()


def test_chat_windows_keep_the_budget(spark):
    windows = chat.chat_windows(conversations(spark, chat_rows()), budget=400, history_tokens=120).collect()
    mine = sorted((w for w in windows if w.conv_id == 1), key=lambda w: w.first_turn)
    assert len(mine) > 50 and all(w.tokens <= 400 and not w.over_budget for w in mine)
    assert all(w.text.startswith("<|im_start|>system\nBe brief.<|im_end|>\n") for w in mine)
    assert all(1 <= w.n_repeated <= 3 for w in mine[1:]) and any(w.n_repeated > 1 for w in mine)
    assert [w.first_turn for w in mine] == np.cumsum([1] + [w.n_new for w in mine])[:-1].tolist()
    for w in windows:
        for span in w.loss:
            assert w.text[:span.start].endswith("<|im_start|>assistant\n")
            assert w.text[span.start + span.length:].startswith("<|im_end|>\n")
    assert any(w.over_budget for w in windows if w.conv_id == 4)


def test_chat_empty(spark):
    none = conversations(spark, chat_rows()).limit(0)
    assert chat.conversation_digests(chat.chat_windows(none)).count() == 0


def plain_hits(docs, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    grams = {}
    for item, t in items:
        w = words(t)
        n = min(len(w), 13)
        for k in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[k:k + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found |= grams[tuple(w[k:k + n])]
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def contamination_cases():
    rng = np.random.default_rng(2)
    vocabulary = [f"w{k}" for k in range(25)] + ["É", "Ab", "straße"]

    def text(n):
        return " ".join(vocabulary[k] for k in rng.integers(0, len(vocabulary), n))

    items = [(k, text(int(rng.integers(13, 40)))) for k in range(12)] + [
        (20, "only FOUR words, here"), (21, "one two three four five six seven eight nine ten eleven twelve"),
        (22, None), (23, " ., "), (None, text(20)), (24, "the " * 30), (3, text(30))]
    docs = [(k, text(int(rng.integers(0, 200)))) for k in range(20)]
    for k, (_, t) in enumerate(items):
        if t:
            w = t.split()
            docs.append((100 + k, text(150) + " " + t.upper() + ". " + text(60)))
            docs.append((200 + k, text(40) + " " + " ".join(w[-13:]) + " " + text(4)))
            docs.append((300 + k, text(40) + " " + " ".join(w[:12])))
    return docs + [(400, "the " * 500), (401, None), (402, ""), (1, "only four words here"), (None, items[0][1])], items


@pytest.mark.parametrize("rows", [1_000_000, 0])  # broadcast and shuffled fingerprints
def test_contaminated(spark, rows):
    docs, items = contamination_cases()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, n_hit int").repartition(3)
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, words string")
    got = decontaminate.contaminated(d, b, broadcast_rows=rows)
    assert sorted(((r[0], r[1], r[2], list(r[3]), r[4]) for r in got.collect()), key=repr) == plain_hits(docs, items)
    long_only = [i for i in items if len((i[1] or "").split()) > 12]
    got = decontaminate.contaminated(d, spark.createDataFrame(long_only, "item_id long, text string"), broadcast_rows=rows)
    assert sorted(((r[0], r[1], r[2], list(r[3]), r[4]) for r in got.collect()), key=repr) == plain_hits(docs, long_only)


def test_contaminated_empty(spark):
    docs, items = contamination_cases()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contaminated(d.limit(0), b).count() == 0
    assert {r.n_hit for r in decontaminate.contaminated(d, b.limit(0)).collect()} == {0}


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


PERSONAL = [
    (1, "card 4539 1488 0343 6467 or 4539148803436467, not 4539148803436468."),
    (2, "again 4539-1488-0343-6467; call +1 (484) 555-1610 or (877) 555-5242 today"),
    (3, "born 1984-02-29, seen 31/12/2001 and 29.02.2023 (no date), ssn 123-45-6789 not 000-12-3456"),
    (4, "host 10.0.255.1 not 10.0.256.1; iban DE89 3704 0044 0532 0130 00 or DE89370400440532013000"),
    (5, "write to Ann.B@example.com or ann.b@EXAMPLE.com"), (6, None), (7, ""), (8, "nothing here but 12 and 2024"),
    (8, "card 4539148803436467"), (None, "4539148803436467"),
]


@pytest.fixture(scope="module")
def rewritten(spark):
    d = spark.createDataFrame([(*r, "x") for r in PERSONAL], "doc_id long, text string, kinds string")
    return {(r.doc_id, k): r for k, r in enumerate(pii.pseudonymised(d.coalesce(1), "key").collect())}


def test_pseudonyms_keep_the_format(rewritten):
    texts = [r.text for r in rewritten.values()]
    cards = re.findall(r"\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}", texts[0] + texts[1])
    assert cards[2] == "4539148803436468" and len(cards) == 4
    flat = {re.sub(r"\D", "", c) for c in (cards[0], cards[1], cards[3])}
    assert len(flat) == 1 and luhn(flat.pop()) and cards[0][4] == " " and cards[3][4] == "-"
    assert texts[8].split()[1] == texts[9] == cards[1]  # linked across documents
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4} or \(\d{3}\) \d{3}-\d{4} today$", texts[1])
    assert "484" not in texts[1] or "1610" not in texts[1]
    assert re.search(r"born (19|20)\d\d-\d\d-\d\d, seen \d\d/\d\d/(19|20)\d\d and 29.02.2023 \(no date\)", texts[2])
    assert "1984-02-29" not in texts[2] and "123-45-6789" not in texts[2] and "000-12-3456" in texts[2]
    assert "10.0.255.1 " not in texts[3] and "10.0.256.1" in texts[3]
    ibans = re.findall(r"DE\d\d(?: ?\d{4}){4} ?\d\d", texts[3])
    assert len(ibans) == 2 and ibans[0].replace(" ", "") == ibans[1] != "DE89370400440532013000"
    assert int(ibans[1][4:] + "1314" + ibans[1][2:4]) % 97 == 1
    mails = re.findall(r"u[0-9a-f]{16}@mail\.invalid", texts[4])
    assert len(mails) == 2 and mails[0] == mails[1]
    assert texts[5] is None and texts[6] == "" and texts[7] == PERSONAL[7][1]
    assert [r.n_replaced for r in rewritten.values()] == [2, 3, 3, 3, 2, 0, 0, 0, 1, 1]


def test_permutations_are_one_to_one(spark):
    days = spark.range(73049).select(pii.feistel(
        F.col("id"), F.lit(17).cast("long"), F.lit(4297).cast("long"), "key", "date").alias("to"), "id")
    back = days.select("id", "to", pii.feistel(
        F.col("to"), F.lit(17).cast("long"), F.lit(4297).cast("long"), "key", "date", back=True).alias("back"))
    row = back.agg(F.countDistinct("to").alias("n"), F.min("to").alias("a"), F.max("to").alias("b"),
                   F.sum((F.col("back") != F.col("id")).cast("int")).alias("bad")).first()
    assert tuple(row) == (73049, 0, 73048, 0)
    digits = spark.range(1000).select(pii.permuted_digits(F.lpad(F.col("id").cast("string"), 3, "0"), "key", "x").alias("d"))
    assert sorted(r.d for r in digits.collect()) == [f"{k:03d}" for k in range(1000)]


def test_pseudonyms_empty(spark):
    d = spark.createDataFrame(PERSONAL, "doc_id long, text string").limit(0)
    assert pii.pseudonymised(d, "key").count() == 0


CARD, GROUPED, IBAN = "4539148803436467", "4539 1488 0343 6467", "ES91 2100 0418 4502 0005 1332"
#: A text, and what has to stay around the pseudonyms of values in it.
BESIDE = [
    (CARD, "{card}"), (f"{CARD} 12/27", "{card} 12/27"), (f"order 77 {CARD}", "order 77 {card}"),
    (f"{GROUPED} 123", "{grouped} 123"), (f"77 {GROUPED} 12 345", "77 {grouped} 12 345"),
    (f"{GROUPED} {GROUPED}", "{grouped} {grouped}"), (f"{CARD} 2024-01-15", "{card} {date}"),
    ("2024-01-15", "{date}"), (f"415-555-2671 {CARD}", "{phone} {card}"), ("415-555-2671", "{phone}"),
    (f"{CARD} 415-555-2671", "{card} {phone}"), (f"{CARD} 415.555.2671", "{card} {dotted}"),
    ("415.555.2671", "{dotted}"), (IBAN, "{iban}"), (f"{IBAN} 2024", "{iban} 2024"), (f"{IBAN} {GROUPED}", "{iban} {grouped}"),
    (GROUPED, "{grouped}"), (f"12 {IBAN} 7", "12 {iban} 7"), (f"FY24 {GROUPED}", "FY24 {grouped}"),
    (f"{IBAN} AB12", "{iban} AB12"), ("+1 415 555 2671", "{world}"), (f"+1 415 555 2671 {GROUPED}", "{world} {grouped}"),
    ("45 39 14 88 03 43 64 67 12/27", "{pairs} 12/27"), ("45 39 14 88 03 43 64 67", "{pairs}"),
    (" ".join(map(str, range(70, 100))), " ".join(map(str, range(70, 100)))),
    ("9 " * 4000 + CARD, "9 " * 4000 + "{card}"),
]


def test_values_beside_other_numbers(spark):
    d = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(BESIDE)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymised(d.coalesce(2), "key").collect()}
    new = {want[1:-1]: got[k].text for k, (_, want) in enumerate(BESIDE) if re.fullmatch("{[a-z]+}", want)}
    assert all(new[name] != t for t, want in BESIDE for name in new if want == f"{{{name}}}")
    assert new["grouped"].replace(" ", "") == new["pairs"].replace(" ", "") == new["card"] and luhn(new["card"])
    for k, (text, want) in enumerate(BESIDE):
        assert got[k].text == want.format(**new), text[:80]
        assert got[k].n_replaced == want.count("{"), text[:80]


def test_phone_in_both_notations(spark):
    texts = ["415-555-2671", "+1 415 555 2671", "(415) 555-2671", "+1 (415) 555-2671", "415.555.2671", "+45 12 34 56 78"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.text for r in sorted(pii.pseudonymised(d, "key").collect())]
    digits = [re.sub(r"\D", "", t) for t in got]
    assert len({x[-10:] for x in digits[:5]}) == 1 and digits[0] != "4155552671" and digits[1][0] == digits[3][0] == "1"
    assert got[5].startswith("+45 ") and len(digits[5]) == 10


#: One number each: national and international notations, and the digits before the national number.
PHONES = [("01 23 45 67 89", "0", "+33 1 23 45 67 89", "33"), ("01.23.45.67.89", "0", "+33 (0)1 23 45 67 89", "330"),
          ("030 12345678", "0", "+49 30 12345678", "49"), ("030/123456", "0", "+49 30 123456", "49"),
          ("(020) 7946 0958", "0", "+44 20 7946 0958", "44"), ("21 123 4567", "", "+351 21 123 4567", "351"),
          ("06 12345678", "0", "+31 6 12345678", "31"), ("06 1234 5678", "0", "+39 06 1234 5678", "390"),
          ("415-555-2671", "", "+1 415 555 2671", "1")]


def test_phone_by_country(spark):
    texts = [t for home, _, abroad, _ in PHONES for t in (f"call {home} now", abroad)]
    got = [r.text for r in sorted(pii.pseudonymised(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string"), "key").collect())]
    for k, (home, trunk, abroad, code) in enumerate(PHONES):
        new_home, new_abroad = got[2 * k][5:-4], got[2 * k + 1]
        assert [re.sub("[0-9]", "9", t) for t in (new_home, new_abroad)] == [
            re.sub("[0-9]", "9", t) for t in (home, abroad)]
        a, b = re.sub(r"\D", "", new_home), re.sub(r"\D", "", new_abroad)
        assert a.startswith(trunk) and b.startswith(code), (home, new_home, new_abroad)
        number = a[len(trunk):]
        assert number == b[len(code):] != re.sub(r"\D", "", home)[len(trunk):] and number[0] != "0"


def test_no_phone(spark):
    texts = ["01 02 2024", "0-306-40615-2", "21 123 456", "1 234 567 890", "+1 2 3", "0123456789", "+1 000 000 0000", "05 06"]
    got = pii.pseudonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "key").collect()
    assert [r.text for r in sorted(got)] == texts


def test_slashed_date(spark):
    got = pii.pseudonymised(spark.createDataFrame(
        [(1, "1980/01/02"), (2, "1980-01-02"), (3, "1980/13/02")], "doc_id long, text string"), "key").collect()
    a, b, c = (r.text for r in sorted(got))
    assert re.fullmatch(r"\d{4}/\d\d/\d\d", a) and a.replace("/", "-") == b != "1980-01-02" and c == "1980/13/02"


def plain_move(key, kind, step, residue):
    return int(hashlib.sha256(f"{key}|{kind}|{step}|{residue}".encode()).hexdigest()[:15], 16)


def plain_digits(digits, key, kind):
    n, half = len(digits), len(digits) // 2
    left, right = int(digits[:half]), int(digits[half:])
    for step in range(pii.ROUNDS):
        if step % 2 == 0:
            left = (left + plain_move(key, f"{kind}{n}", step, right) % 10 ** half) % 10 ** half
        else:
            right = (right + plain_move(key, f"{kind}{n}", step, left) % 10 ** (n - half)) % 10 ** (n - half)
    return f"{left:0{half}d}{right:0{n - half}d}"


def test_permutation_against_plain_python(spark):
    rng = np.random.default_rng(9)
    values = ["".join(map(str, rng.integers(0, 10, n))) for n in range(2, 37)] * 2
    d = spark.createDataFrame([(v,) for v in values], "v string").coalesce(1)
    got = [r.p for r in d.select(pii.permuted_digits(F.col("v"), "key", "phone").alias("p")).collect()]
    assert got == [plain_digits(v, "key", "phone") for v in values]
    phone = pii.pseudonymised(spark.createDataFrame([(1, "+44 20 7946 0958")], "doc_id long, text string"), "key").first()
    number = plain_digits("2079460958", "key", "phone")
    while number[0] == "0":
        number = plain_digits(number, "key", "phone")
    assert re.sub(r"\D", "", phone.text) == "44" + number


def secret_rows():
    rng = np.random.default_rng(3)
    hexes = ["".join("0123456789abcdef"[k] for k in rng.integers(0, 16, 40)) for _ in range(60)]
    keys = ["AKIA" + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[k] for k in rng.integers(0, 32, 16)) for _ in range(60)]
    prose = "the internationalisation of misunderstandings is a counterproductive characteristic "
    rows = [(k, prose * 3 + f'token = "{h}" and so on {"9" * 17}') for k, h in enumerate(hexes)]
    rows += [(100 + k, prose + f"use {h} now " + prose) for k, h in enumerate(keys)]
    rows += [(200 + k, prose + f"commit {h[::-1]} fixed it") for k, h in enumerate(hexes)]
    return rows + [(300, None), (301, ""), (302, "short"), (None, f'secret: "{hexes[0]}"')], hexes, keys


def test_secrets(spark):
    rows, hexes, keys = secret_rows()
    d = spark.createDataFrame([(i, t, "src/main.py", 1) for i, t in rows], "doc_id long, text string, source string, start int")
    found = staged(secrets.candidates(d))
    texts = dict(rows)
    for r in found.collect():
        assert texts[r.doc_id][r.start:].startswith(r.value) and texts[r.doc_id][:r.start].endswith(r.before)
    scanner = secrets.fit(d, secrets.weak_labels(found))
    kept = secrets.secrets(found, scanner)
    got = {(r.doc_id, r.value_sha256) for r in kept.collect()}
    wanted = {(k, h) for k, h in enumerate(hexes)} | {(100 + k, h) for k, h in enumerate(keys)} | {(None, hexes[0])}
    wanted = {(k, hashlib.sha256(h.encode()).hexdigest()) for k, h in wanted}
    assert wanted <= got and len(got - wanted) <= 3
    assert secrets.secrets(found.limit(0), scanner).count() == 0
    # labelled findings without an id train as well
    nameless = secrets.fit(d, secrets.weak_labels(found).withColumn("doc_id", F.lit(None).cast("long")))
    assert nameless.forest is not None and wanted <= {
        (r.doc_id, r.value_sha256) for r in secrets.secrets(found, nameless).collect()}


def test_secrets_on_held_out_documents(spark):
    rows, _, _ = secret_rows()
    d = spark.createDataFrame([(i, t, "src/main.py") for i, t in rows], "doc_id long, text string, source string")
    labelled = staged(secrets.weak_labels(secrets.candidates(d)))
    held = {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    row = secrets.held_out_quality(d, labelled).first()
    assert row.n == labelled.filter(F.col("doc_id").isin(held)).count() and row.secrets > 10
    assert row.right >= 0.95 * row.secrets and row.right >= 0.95 * row.found
    # without the names, digests cannot be told from tokens; known formats still can
    blind = secrets.held_out_quality(d, labelled, withheld=("secret_name", "other_name", "assigned", "quoted")).first()
    assert blind.n == row.n and 0.3 * row.secrets <= blind.right and blind.found > blind.right


def test_secrets_without_labels(spark):
    d = spark.createDataFrame([(1, "internationalisation of it", None)], "doc_id long, text string, source string")
    found = secrets.candidates(d)
    scanner = secrets.fit(d, secrets.weak_labels(found).limit(0))
    assert [r.score for r in secrets.secrets(found, scanner).collect()] == [0.5]


def test_context_reaches_over_other_candidates(spark):
    value = "9f8e7d6c5b4a39281706f5e4d3c2b1a0"
    texts = [f"export AWS_SECRET_ACCESS_KEY={value} # é", f'{{"client_secret_key": "{value}"}}',
             f"{value} {value} internationalisation {value}-"]
    d = spark.createDataFrame([(k, t, "a.py") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    found = secrets.candidates(d)
    rows = found.collect()
    for r in rows:
        text, end = texts[r.doc_id], r.start + len(r.value)
        assert text[r.start:end] == r.value and r.before == text[max(r.start - secrets.CONTEXT, 0):r.start]
        assert r.after == text[end:end + secrets.CONTEXT]
    described = secrets._described(found, [0.0] * secrets._WIDE ** 2, [False] * 26 ** 3)
    got = [(r.secret_name, r.assigned) for r in described.filter("doc_id < 2").collect() if r.value == value]
    assert got == [(1.0, 1.0)] * 2
    positive = {r.doc_id for r in secrets.weak_labels(found).filter("label = 1").collect() if r.value == value}
    assert {0, 1} <= positive


ASSIGNED = [
    ("password = hunter2!x", "hunter2!x"), ("api_key: abc123def456,", "abc123def456"),
    ('{"db_password": "p@$$w0rd%, 1"}', None), ('{"db_password": "p@$$w0rd%,1"}', "p@$$w0rd%,1"),
    ("postgres://user:p@ss#w0rd@db.example.com/x", "p@ss#w0rd"), ("redis://:hunter2@cache:6379", "hunter2"),
    ("Server=x;Password=hun;ter2!x;Database=prod", "hun;ter2!x"), ("passphrase => 'tr0ub4dor&3'", "tr0ub4dor&3"),
    ("DATABASE_MASTER_PASSWORD=ab!12#z", "ab!12#z"), ("AUTH_TOKEN: `x y`", None), ("the word hunter2!x alone", None),
    ("https://example.com:8080/a@b", None), ("auth: https://u:hunter2!@h/", "hunter2!"), ("passwd=é!x#12 now", "é!x#12"),
    ("password = short", None),
]


def test_assigned_values_of_any_characters(spark):
    d = spark.createDataFrame([(k, t, "a.py") for k, (t, _) in enumerate(ASSIGNED)], "doc_id long, text string, source string")
    got = {}
    for r in secrets.candidates(d).collect():
        assert ASSIGNED[r.doc_id][0][r.start:r.start + len(r.value)] == r.value
        got.setdefault(r.doc_id, []).append(r.value)
    for k, (text, value) in enumerate(ASSIGNED):
        if value:
            assert value in got[k], (text, got.get(k))
        else:
            assert not any(len(v) < secrets.LEAST_LENGTH for v in got.get(k, [])), (text, got[k])


def test_short_secrets_are_kept(spark):
    rows, hexes, keys = secret_rows()
    rng = np.random.default_rng(5)
    short = ["".join("abcdefghkmnp23456789!@#$%"[k] for k in rng.integers(0, 25, 11)) + "a7!" for _ in range(60)]
    rows = rows + [(400 + k, f"here the password = {v} and more") for k, v in enumerate(short)]
    rows += [(500 + k, f"reset password: {w} and go on") for k, w in enumerate(["please", "changed", "required"] * 20)]
    d = spark.createDataFrame([(i, t, "src/main.py") for i, t in rows], "doc_id long, text string, source string")
    found = secrets.candidates(d)
    kept = secrets.secrets(found, secrets.fit(d, secrets.weak_labels(found))).collect()
    got = {r.doc_id for r in kept if r.doc_id is not None}
    assert len(got & set(range(400, 460))) >= 55 and not got & set(range(500, 560))
