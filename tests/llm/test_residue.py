import numpy as np
import pytest

from wirelake.llm import residue as rs

SEEDS = rs.seed_labels()
CASES = [
    "Service Unavailable: You don't have permission to view this resource.", "${autor} - %%NOME_DO_SITE%%", "Em X, a frota {{ post.resumo }} revisou a licença.", "Erro 404", "A empresa [object Object] comentou.", "o None None 30 participantes",
    "Lorem ipsum dolor sit amet consectetur.", "Adipiscing elit eiusmod labore incididunt tempor do sed ut.", "aaaa bbbb cccc teste teste teste 35,3 teste", "Texto de exemplo. Texto de exemplo.", "Notícia real.\nXXXX Your caption goes here.",
    "<noscript>Checking that you are human. This may take a few seconds. (ref. 12.9)</noscript>", "您的浏览器不支持脚本。", "Страница не найдена - номер обращения: 5", "الصفحة غير موجودة", "הגישה נדחתה - מספר פנייה: 3", "[titulo AQUI]", "能源{lide}恢复", "价格%%author%%时",
    "<html><head><title>Página não encontrada</title></head><body><h1>Tempo de resposta esgotado. O servidor Belpiu não respondeu a tempo.</h1></body></html>", "null",
]
NEWS = [
    "Durante a consulta pública, o portal da X exibiu “erro 404” por 82 horas e o prazo foi estendido.", "A lei de cookies obriga a X a pedir licença aos leitores.", "X hired 66 JavaScript developers for its new price dashboard.", "Motoristas tiveram o acesso negado ao terminal por falta de cadastro.",
    "The auction page was unavailable and 52 bids were lost.", "A portaria {260/903} da X vale desde ontem.", "Todos os direitos reservados a X.", "Siga X no canal de mensagens", "\\begin{itemize} \\item a \\end{itemize} \\mathrm{zol}", '{"feed": "rin", "items": 84}', "Leia mais", "TODOS OS DIREITOS", "A culpa é do bloqueador de anúncios.",
    "{margin:0}", "None of the bids was accepted.", "[[Pet|x]]", "50% de biodiesel e 30% de etanol",
]


def direct(t):
    return bool(rs.FIELD.search(t) or rs.STAND_IN.search(t) or any(f in SEEDS or rs.rule_label(f) for f in rs.fragments(t)))


@pytest.mark.parametrize("t", CASES)
def test_cases(t):
    assert direct(t)


@pytest.mark.parametrize("t", NEWS)
def test_news(t):
    assert not direct(t)


def test_simhash_bits():
    from wirelake.llm.neardup import shingle_hashes

    texts = ["abcdefgh" * 90, "hello world", "ab", "", "x" * 700 + "yz"]
    doc, h = shingle_hashes(texts)
    sim = rs.simhash(texts).view(np.uint64)
    for i in range(len(texts)):
        own = h[doc == i]
        want = sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in own) > len(own))
        assert sim[i] == want


def records(spark, texts):
    return spark.createDataFrame([("t", i, t) for i, t in enumerate(texts)], "rec_table string, rec_id long, text string")


@pytest.mark.parametrize("frontier", [rs.FRONTIER, 0])
def test_labels_spread_through_the_component(spark, frontier):
    """A chain of near copies is followed to its end, with tables in the tasks and with joined keys."""
    first = "please wait while the gate of our site looks at the kind of program that asks for this page"
    second, third = first.replace("this page", "that page"), first.replace("this page", "that page again")
    texts = [first, second, third, third, "a completely different sentence about oil prices in the north sea basin"]
    got = {(r.rec_id, r.how) for r in rs.residue(records(spark, texts), {first: "notice"}, frontier).collect()}
    assert got == {(0, "seed"), (1, "copy"), (2, "copy"), (3, "copy")}


def test_companions_of_messages(spark):
    known = {"page not found": "error", "access denied": "error", "bad gateway": "error", "forbidden": "error"}
    pages = [f"{k}. Go back to the front page. {i}" for i, k in enumerate(known)]
    copied = ["Forbidden. Oil rose two percent on Monday.", "Forbidden. Oil rose two percent on Monday. x", "Forbidden. Oil rose two percent on Monday. y", "Forbidden. Oil rose two percent on Monday. z", "Oil rose two percent on Monday."]
    got = {r.rec_id: r.how for r in rs.residue(records(spark, [*pages, *copied, "Go back to the front page."]), known).collect()}
    assert got == {**{i: "seed" for i in range(8)}, 9: "companion"}


def test_half_of_the_seeds(spark):
    """Pages of three messages out of twelve: half of the seeds finds them all."""
    rng = np.random.default_rng(3)
    words = ["amber", "birch", "cedar", "delta", "ember", "fjord", "grove", "hazel", "inlet", "jetty", "knoll", "larch"]
    messages = [f"the {w} gate gave no answer" for w in words]
    texts = [". ".join(np.array(messages)[rng.permutation(12)[:3]]) + f". news {i} of {i * 7}" for i in range(200)] + [f"news of day {i} and {i * 3}" for i in range(100)]
    found = rs.residue(records(spark, texts), {m: "error" for m in messages[::2]}).count()
    assert found == 200


def test_records(spark):
    rows = [("articles", i, t) for i, t in enumerate(CASES)] + [("raw_items", i, t) for i, t in enumerate(NEWS)] + [("raw_items", 100, None), ("raw_items", 101, ""), ("raw_items", 102, " \n"), ("raw_items", None, "Erro 404"), ("articles", 0, CASES[0])]
    df = spark.createDataFrame(rows, "rec_table string, rec_id long, text string").selectExpr("*", "1 as inline", "'x' as label")
    got = {tuple(r)[:2] for r in rs.residue(df).collect()}
    assert got == {("articles", i) for i in range(len(CASES))} | {("raw_items", None)}
    assert rs.residue(df.limit(0)).count() == 0
    long = spark.createDataFrame([("t", 1, "palavra normal " * 50_000 + "\nErro 404")], "rec_table string, rec_id long, text string")
    assert rs.residue(long).count() == 1
