import pytest
from pyspark.sql import functions as F

from parcelyze.llm import language_id
from parcelyze.llm.queries import QUERIES

from . import cases

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = QUERIES["op8_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = got.filter("held_out").agg(F.count("*").alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("acc"),
                                   F.avg(F.col("rejected").cast("int")).alias("gone")).first()
    assert r["n"] > 150 and r["acc"] > 0.95 and r["gone"] < 0.02
    assert got.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_fold_follows_crc32(spark):
    import zlib
    got = spark.range(200).select("id", language_id.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS id").select(language_id.held_out("id")).first()[0] is False


@pytest.fixture(scope="module")
def model(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    return language_id.fit(d, train=language_id.train_fold())


def test_bounds_and_one_dictionary_per_language(model):
    assert sorted(k for k, _ in model.dictionaries) == ["de", "en", "es", "fr"]
    assert all(len(v) <= 112_640 for _, v in model.dictionaries)


def test_awkward_texts(spark, model):
    rows = {r["doc_id"]: r for r in language_id.predict(cases.docs(spark), model).collect()}
    for i in (102, 103, 104):
        assert (rows[i]["lang_pred"], rows[i]["score"], rows[i]["rejected"]) == ("und", 0.0, True)
    assert rows[108]["lang_pred"] in {k for k, _ in model.dictionaries}


def test_other_columns_pass_and_clashing_ones_go(spark, model):
    df = cases.with_extra(cases.docs(spark))
    got = language_id.predict(df, model)
    assert got.columns == [c for c in df.columns if c not in ("score", "rejected")] + ["lang_pred", "score", "rejected"]
    assert got.count() == df.count()


def test_long_texts_are_read_whole(model):
    enc = language_id.Encoder(model)
    d = dict(model.dictionaries)
    tail = d["de"][:60_000].decode("utf-8", "ignore")
    assert enc.predict("the of " * 10 + tail)[0] == "de"


def test_ties_short_texts_and_empty_tables(spark, model):
    enc = language_id.Encoder(model)
    assert enc.predict("q")[2]                              # a tie is rejected at every size
    assert language_id.predict(cases.empty(spark), model).count() == 0
    none = language_id.fit(cases.empty(spark))
    assert none.dictionaries == []
    assert [r.lang_pred for r in language_id.predict(cases.docs(spark, [(1, "hello there", "en", "s", 11)]), none).collect()] == ["und"]


def test_undecided_long_text_is_rejected(model):
    d = dict(model.dictionaries)
    same = language_id.Model([("a", d["en"]), ("b", d["en"])])
    assert language_id.Encoder(same).predict(d["en"][:5000].decode("utf-8", "ignore") * 3 + "zqzq " * 900)[2] is True


def test_short_texts_that_all_dictionaries_pack_alike_are_rejected(model):
    enc = language_id.Encoder(model)
    for t in ("q", "x", "xkcd qwrt zzpl", "Привет как дела", "日本語のテキスト", "http://a.b/c?d=1"):
        assert enc.predict(t)[1:] == (0.25, True)


def test_clean_short_texts_stay(spark, model):
    enc = language_id.Encoder(model)
    assert enc.predict("the cat sat on the mat")[::2] == ("en", False)
    assert enc.predict("Le chat est sur la table")[::2] == ("fr", False)
    rows = spark.read.parquet(f"{SF}/documents.parquet").filter(language_id.held_out()).select("text", "lang").collect()
    for size in (25, 40, 100, 300):
        cut = [(enc.predict(r["text"][:size]), r["lang"]) for r in rows if len(r["text"] or "") >= size]
        assert sum(g[2] for g, _ in cut) <= 0.03 * len(cut)
        assert sum(g[0] == k for g, k in cut) >= 0.97 * len(cut)


def packed(content, text, level, block, lead=b""):
    """The size of a text by the zstandard library, written out plainly."""
    import zstandard as z
    import re
    words = re.sub(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+", b" ", text.lower().encode()).strip()
    d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
    c = z.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
    return sum(len(c.compress(lead + words[i:i + block])) for i in range(0, len(words), block))


def test_same_language_as_every_dictionary_tried_one_by_one(spark, model):
    enc = language_id.Encoder(model)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("text").collect() if r.text]
    texts = [t for t in texts if any(map(str.isalpha, t))]
    for t in [*texts[::9], *[t[:30] for t in texts[::11]]]:
        if not any(map(str.isalpha, t)):
            continue
        s = [packed(d, t, model.level, model.block_bytes) for _, d in model.dictionaries]
        if sorted(s)[0] == sorted(s)[1]:
            s = [packed(d, t, model.fine_level, model.block_bytes, b" " * 64) for _, d in model.dictionaries]
        low, second = sorted(s)[:2]
        lang, score, rejected = enc.predict(t)
        assert lang == model.dictionaries[s.index(low)][0]
        assert rejected == (second - low <= model.min_margin * low)
        assert score == pytest.approx(1 / sum(2.0 ** (-0.1 * min(x - low, 1000)) for x in s))


def test_a_language_with_a_short_sample_is_learned(spark):
    rows = [(i, "the cat sat on the mat and the dog ran after it", "en", "s", 1) for i in range(5)]
    m = language_id.fit(cases.docs(spark, [*rows, (9, "och", "sv", "s", 3), (10, "1 2 3", "xx", "s", 5)]))
    assert sorted(k for k, _ in m.dictionaries) == ["en", "sv"]
    assert language_id.Encoder(m).predict("och och och och och och och och")[0] == "sv"


def test_columns_of_the_same_name_keep_their_values(spark, model):
    df = cases.with_extra(cases.docs(spark))
    got = language_id.predict(df, model, names=("a1", "a2", "a3"))
    assert got.columns == [*df.columns, "a1", "a2", "a3"]
    assert got.select("score", "rejected").distinct().collect() == [("x", "e")]
