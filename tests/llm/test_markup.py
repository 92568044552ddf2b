import pytest

from wirelake.llm import markup as m

MARKED = [
    ("html", "<p>a</p>"), ("html", "a<br/>b"), ("html", "a &nbsp; b"), ("html", "x &lt;b&gt;y&lt;/b&gt;"), ("html", "<![CDATA[x]]>"), ("html", "a <!-- c --> b"), ("html", "x&#8211;y"),
    ("markdown", "# Título\ntexto"), ("markdown", "a **b c** d"), ("markdown", "[a](https://x.example/y)"), ("markdown", "> ~~1~~ x"), ("markdown", "```sql\nselect\n```"), ("markdown", "价__格上__调"), ("markdown", "| a | b |\n|---|---|\n| 1 | 2 |"), ("markdown", "1. a\n2. b"),
    ("wiki", "== Título ==\nx"), ("wiki", "a ''b'' c"), ("wiki", "[[a|b]]"), ("wiki", "{|\n|-\n| a\n|}"), ("wiki", "[https://x.example y]"), ("wiki", "'''A''' b"),
    ("latex", "\\section{A} b"), ("latex", "a \\emph{b} c"), ("latex", "$E = 5 \\times 10^{3}$"), ("latex", "\\[x\\]"), ("latex", "\\begin{itemize}\n\\item a\n\\end{itemize}"),
]
PLAIN = [
    "A conta é simples: 49,3 * 82 litros por dia.", "O setor de P&D cresceu 9%.", "O arquivo relatorio_final_85,7.pdf circula.", "termina com a sigla [...] e não explica", "margem < 13% neste ano e > 5% no próximo",
    "O barril oscilou entre US$ 37.175 e US$ 56,5 na bolsa.", "A plataforma 'P-747' segue parada.", "— Não vamos parar, disse.", "A portaria {260/903} vale.", "{{ post.resumo }}", "${autor}", "%%autor%% | @@lide@@", "[object Object]", "texto…", "", "  \n", None,
    "[titulo AQUI] {lide}",
]


@pytest.mark.parametrize("kind,text", MARKED)
def test_kinds(kind, text):
    assert kind in m.kinds(text)


@pytest.mark.parametrize("text", PLAIN)
def test_no_markup(text):
    assert m.kinds(text) == []


def clean(t):
    return m.clean(t, m.kinds(t))


def test_structure_is_kept():
    assert clean("<h2>Título</h2><p>Um &amp; dois</p><ul><li>a<li>b</ul>") == "## Título\n\nUm & dois\n\n- a\n- b"
    assert clean("<p>x</p><pre><code>{&quot;a&quot;: 1}\n  y</code></pre>") == 'x\n\n```\n{"a": 1}\n  y\n```'
    assert clean("<script>var a='<p>'</script><style>.x{}</style>Texto") == "Texto"
    assert clean("&lt;p&gt;um&lt;/p&gt;&lt;p&gt;dois&lt;/p&gt;") == "um\n\ndois"
    assert clean("== Título ==\n* [[a|b]]: c\nx '''y''' [https://u.example z]") == "## Título\n- b: c\nx y z"
    assert clean("\\section*{A}\n\\begin{itemize}\n\\item um\n\\item \\textbf{dois}\n\\end{itemize}\n\\begin{equation} E = 5 \\times 10^{3} \\end{equation} \\cite{k}") == "# A\n- um\n- dois\n\n$$E = 5 \\times 10^{3}$$"
    assert clean("## A\n\n* **x** y\n> ~~1~~ z\n\n```\na_b * c\n```\n[t](https://u.example/)") == "## A\n\n- x y\n1 z\n\n```\na_b * c\n```\nt"
    assert clean("custa $5 e $6") == "custa $5 e $6"
    assert clean(None) == "" and clean(" \r\n ") == ""


def test_longest_common_subsequence():
    import random

    r = random.Random(2)
    for _ in range(200):
        a, b = ([r.choice("abcd") for _ in range(r.randrange(8))] for _ in range(2))
        got = m.common_lines(a, b)
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                t[i][j] = t[i + 1][j + 1] + 1 if a[i] == b[j] else max(t[i + 1][j], t[i][j + 1])
        it = iter(b)
        assert len(got) == t[0][0] and got == sorted(set(got)) and all(a[i] in it for i in got)


def test_differencing(spark):
    rows = [
        ("articles", 1, "https://www.h.example/a/1", "Texto um que é bem próprio da página\nSiga o canal\n<b>fim</b> próprio"),
        ("articles", 2, "https://h.example/a/2?x=1", "Outro texto da outra página, também próprio\nSiga o canal\nfim"),
        ("articles", 3, "https://g.example/a/2", "Siga o canal"),
        ("raw_items", 1, "https://h.example/a/2", "Outro texto da outra página, também próprio\nSiga o canal\nfim"),
        ("raw_items", 5, None, None),
        ("raw_items", None, "x", "<p>y</p>"),
        ("raw_items", 7, "https://c.example/1", "```\nx = 1\n```\num"),
        ("raw_items", 8, "https://c.example/2", "```\ny = 2\n```\ndois"),
    ]
    df = spark.createDataFrame(rows, "rec_table string, rec_id long, url string, text string").withColumn("host", __import__("pyspark").sql.functions.lit(1))
    got = {(r.rec_table, r.rec_id): r for r in m.difference(df.coalesce(1)).collect()}
    assert len(got) == len(rows)
    assert "Siga o canal" not in got["articles", 1].clean and got["articles", 1].shared_lines == 1 and got["articles", 1].kinds == ["html"]
    assert got["articles", 1].clean.endswith("fim próprio") and got["articles", 3].clean == "Siga o canal"
    assert "Siga o canal" not in got["articles", 2].clean
    assert got["raw_items", 8].clean == "```\ny = 2\n```\ndois" and got["raw_items", 5].clean == "" and got["raw_items", None].kinds == ["html"]
    assert m.difference(df.limit(0)).count() == 0


def test_long_text():
    t = "<p>" + "a " * 300_000 + "</p>"
    assert m.kinds(t) == ["html"] and len(clean(t)) > 500_000
