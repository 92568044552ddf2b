"""Where the sites keep the bodies of their articles: rows ``domain, spec`` for ``functions.html.extract``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wirelake.functions.html import DEFAULT_SELECTORS

GENERIC = "|".join(DEFAULT_SELECTORS)

# Body selectors by family of sites, in order of trial.
SELECTORS = {
    "globo": "div.mc-article-body|article .mc-article-body|article .content-text__container|article",
    "folha": "div.c-news__body|article.c-news|div.c-main-content|article",
    "estadao": "div.content-wrapper.news-body|div.news-body|div.template-reportagem|div.n--noticia__content|div.noticia__conteudo|section.n--noticia__content|article",
    "brasilenergia": "div.editorial_|div.descricao-noticia|div.single-content|div.entry-content|article",
    "metropoles": "div.m-news__body|div.texto-materia|article .noticia-conteudo|article",
    "poder360": "div.entry-content|article .post-content|article",
    "infomoney": "div.article__content|div.single__content|div.im-article|article",
    "bloomberglinea": "div.article-content|div.article-body|article",
    "r7": "div.b-article__body|div.article-content|article",
    "petrobras": "div.entry-content|article .post-content|article",
    "agenciainfra": ".elementor-widget-theme-post-content .elementor-widget-container|div.entry-content|article .post-content|article",
    "braziljournal": "div.post-content-text|section.post-content|div.entry-content|article",
    "eixos": "div.entry-content|div.post-content|article .tdb-block-inner|article",
    "monitormercantil": "div.td-post-content|div.entry-content|article",
    "timesbrasil": "div.article-content|div.entry-content|article",
    "visaoagro": "div.entry-content|div.post-content|article",
    "gazetadopovo": 'div[class*="postBodyContainer"]|div[class*="postBody"]|div[class*="postContent"]',
    "jornaldocomercio": 'br:section[class*="paywall-carregando"]|section[class*="paywall"]|div[class*="paywall-carregando"]',
    "jota": 'json:props.pageProps.post.content|div[itemprop="articleBody"]|div.entry-content|article',
    "generic": GENERIC,
}

# The sites of each family; each stands for its address with "www." too.
SITES = {
    "globo": "valor.globo.com oglobo.globo.com g1.globo.com pipelinevalor.globo.com globorural.globo.com cbn.globo.com",
    "folha": "www1.folha.uol.com.br folha.uol.com.br aovivo.folha.uol.com.br",
    "estadao": "estadao.com.br estradao.estadao.com.br",
    "brasilenergia": "brasilenergia.com.br",
    "metropoles": "metropoles.com",
    "poder360": "poder360.com.br",
    "infomoney": "infomoney.com.br",
    "bloomberglinea": "bloomberglinea.com.br",
    "r7": "noticias.r7.com",
    "petrobras": "agencia.petrobras.com.br",
    "agenciainfra": "agenciainfra.com",
    "jota": "jota.info",
    "braziljournal": "braziljournal.com",
    "eixos": "eixos.com.br",
    "monitormercantil": "monitormercantil.com.br",
    "timesbrasil": "timesbrasil.com.br",
    "visaoagro": "visaoagro.com.br",
    "gazetadopovo": "gazetadopovo.com.br",
    "jornaldocomercio": "jornaldocomercio.com",
    "generic": "theagribiz.com cnnbrasil.com.br veja.abril.com.br investnews.com.br neofeed.com.br cnbc.com exame.com istoedinheiro.com.br brasil247.com"
    " observatorio.firjan.com.br megawhat.uol.com.br reuters.com br.investing.com correiobraziliense.com.br correiodopovo.com.br atribuna.com.br veronoticias.com"
    " diariodopoder.com.br conjur.com.br argusmedia.com operamundi.uol.com.br claudiodantas.com.br br.tradingview.com theedgesingapore.com itatiaia.com.br",
}


def rows() -> list[tuple[str, str]]:
    return [(d, SELECTORS[family]) for family, sites in SITES.items() for site in sites.split() for d in ((site,) if site.startswith("www") else (site, "www." + site))]


def extractor_rows(spark: SparkSession) -> DataFrame:
    """``domain, spec``: one row per site address."""
    return spark.createDataFrame(rows(), "domain string, spec string")
