"""Ordinary prose of several scripts is not taken for repetitive."""

from pydoc_data.topics import topics

import pytest

from eventloom.llm import quality

PROSE = {
    "ru": "Утром мы вышли из дома, когда над рекой ещё стоял туман. Старый паром медленно отходил от берега, и "
          "перевозчик рассказывал, как в прошлом году вода поднялась до самых окон. На другом берегу начинался лес, "
          "а за лесом лежала деревня, где нас ждали к обеду. Дорога оказалась длиннее, чем мы думали: после дождя "
          "колеи размыло, и пришлось идти краем поля. Мой брат нёс корзину с хлебом, сестра пела, а я смотрел, как "
          "солнце поднимается над верхушками сосен. К полудню стало жарко. Мы остановились у колодца, напились "
          "холодной воды и поделили яблоки. Никто не торопился, потому что впереди был целый день.",
    "el": "Το πρωί βγήκαμε από το σπίτι ενώ πάνω από το ποτάμι υπήρχε ακόμη ομίχλη. Το παλιό καράβι έφευγε αργά από "
          "την όχθη και ο βαρκάρης μας έλεγε πώς πέρυσι το νερό ανέβηκε μέχρι τα παράθυρα. Στην απέναντι πλευρά "
          "άρχιζε το δάσος και πίσω του βρισκόταν το χωριό όπου μας περίμεναν για φαγητό. Ο δρόμος ήταν πιο μακρύς "
          "απ' όσο νομίζαμε, γιατί η βροχή είχε χαλάσει το μονοπάτι. Το μεσημέρι έκανε ζέστη, σταματήσαμε στο "
          "πηγάδι, ήπιαμε κρύο νερό και μοιραστήκαμε τα μήλα. Κανείς δεν βιαζόταν.",
    "hi": "सुबह हम घर से निकले तो नदी के ऊपर अभी भी कोहरा था। पुरानी नाव धीरे धीरे किनारे से दूर जा रही थी और नाविक बता रहा था कि "
          "पिछले साल पानी खिड़कियों तक आ गया था। दूसरे किनारे पर जंगल शुरू होता था और जंगल के पीछे वह गाँव था जहाँ लोग दोपहर के खाने "
          "पर हमारा इंतज़ार कर रहे थे। रास्ता हमारी सोच से लंबा निकला, क्योंकि बारिश ने पगडंडी खराब कर दी थी। मेरा भाई रोटी की टोकरी "
          "लिए चल रहा था, बहन गा रही थी और मैं पेड़ों के ऊपर उगते सूरज को देख रहा था। दोपहर तक गर्मी बढ़ गई। हम कुएँ के पास रुके, ठंडा "
          "पानी पिया और सेब बाँट कर खाए। किसी को जल्दी नहीं थी।",
    "zh": "清晨我们离开家时，河面上还笼罩着薄雾。旧渡船缓缓驶离岸边，船夫讲起去年大水一直涨到窗台的事。对岸是一片森林，林子后面有个村庄，"
          "那里的人正等我们去吃午饭。路比想象中更长，雨水冲坏了小道，我们只好沿着田边走。哥哥提着装面包的篮子，妹妹唱着歌，我望着太阳从松树"
          "顶上升起来。到了中午，天气渐渐炎热，大家在井旁停下，喝了凉水，又把苹果分着吃了。谁也不着急，因为还有整整一天的时间。",
}


def test_documentation_is_kept(docs_of):
    got = quality.quality_rules(docs_of(list(topics.values()))).filter("not base_failed").collect()
    assert len(got) > 50
    assert [(r.doc_id, r.band) for r in got if not r.kept] == []


@pytest.mark.parametrize("lang", PROSE)
def test_prose_of_several_scripts(docs_of, lang):
    [row] = quality.quality_rules(docs_of([PROSE[lang]])).collect()
    assert row.band != "repetitive", (row.ratio, len(PROSE[lang].encode()))


@pytest.mark.parametrize("lang", PROSE)
def test_repeated_prose_still_goes(docs_of, lang):
    [row] = quality.quality_rules(docs_of(["\n".join([PROSE[lang]] * 10)])).collect()
    assert row.band == "repetitive" and not row.kept


def test_fitted_limits_reject_bad_texts_and_keep_clean_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").filter("quality is not null").select("doc_id", "quality")
    got = quality.quality_rules(docs).filter("not base_failed").join(labels, "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n[0, False] > 0.5 * (n[0, False] + n[0, True]), n
    assert n[1, True] >= 0.99 * (n.get((1, False), 0) + n[1, True]), n


def test_copies_do_not_move_the_limits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    one = docs.filter("length(text) between 1000 and 2000").limit(1)
    copies = one.crossJoin(spark.range(3000).select("id")).selectExpr("id + 10000000 as doc_id", "text")
    assert quality.fit_bands(docs) == quality.fit_bands(docs.union(copies)) != quality.Bands()
    assert quality.fit_bands(docs.limit(0)) == quality.Bands()
