"""Texts in languages that were not learned, gibberish of known letters, and mixtures of known languages."""

import random

import pytest
from brute import SMALL
from pyspark.sql import functions as F

from editengine.llm import langid

DUTCH = "De hoofdstad van Nederland is Amsterdam, maar de regering zetelt in Den Haag. Het land grenst in het oosten aan Duitsland en in het zuiden aan de Noordzee, waar vissers al eeuwen hun brood verdienen. "
POLISH = "Stolica Polski jest Warszawa, a kraj lezy w srodkowej Europie nad Morzem Baltyckim. Wiekszosc mieszkancow mowi po polsku, a najwyzsze gory znajduja sie na poludniu, przy granicy ze Slowacja. "
FINNISH = "Suomen paakaupunki on Helsinki ja maassa on tuhansia jarvia. Talvella paivat ovat lyhyita ja kesalla aurinko ei laske lainkaan pohjoisessa. "


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_unlearned_languages_and_gibberish_go_and_mixtures_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.fit(docs)
    rng = random.Random(1)
    gibberish = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n)) for n in (8, 60, 2000)]
    bad = [x for text in (DUTCH, POLISH, FINNISH) for x in (text[:60], text, text * 20)] + gibberish
    rows = docs.orderBy("doc_id").select("lang", "text").collect()
    of = {lang: [r["text"] for r in rows if r["lang"] == lang] for lang in ("en", "de", "fr", "es")}
    good = [" ".join(x[:600] for x in texts) for texts in zip(*(x[:8] for x in of.values()), strict=True)] + [a[:400] + "\n" + b[:400] for a, b in zip(of["en"][:8], of["fr"][:8], strict=True)]
    frame = spark.createDataFrame([(-1 - k, x) for k, x in enumerate(bad)] + list(enumerate(good)), "doc_id long, text string")
    assert {r["doc_id"] for r in langid.identify(frame, model).where("accepted").collect()} == set(range(len(good)))
    assert {r["doc_id"] for r in langid.accept(frame, model).collect()} == set(range(len(good)))
    lettered = docs.where(F.expr(r"text rlike '\\p{L}'"))
    assert langid.accept(docs, model).count() >= 0.999 * lettered.count()


def test_a_single_learned_language_does_not_accept_everything():
    rng = random.Random(2)
    words = "the of and to in is that for it with as was on are by this be from or an at which not have".split()
    text = lambda: " ".join(rng.choice(words) for _ in range(70)).encode()
    model = langid.train([text() for _ in range(300)], ["en"] * 300)
    assert model.judge([text(), POLISH.encode()])[1].tolist() == [True, False]
