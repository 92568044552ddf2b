"""Default keywords and the native terms of the search languages."""

from __future__ import annotations

# Keywords used where neither the defaults nor a user names any.
DEFAULT_KEYWORDS = (
    "petróleo", "petroleo", "Petrobras", "Vibra", "Brava", "Ultrapar", "Ipiranga", "PetroReconcavo", "PetroRecôncavo",
    "oil", "gasolina", "gás", "gas", "diesel", "combustível", "combustivel", "combustíveis", "combustiveis",
    "OceanPact", "Cosan", "Raízen", "Raizen", "Braskem", "Compass", "PRIO",
)

# English terms by priority.
ENGLISH = ("oil", "gas", "diesel", "Brent", "WTI", "OPEC", "crude", "LNG", "refinery", "gasoline", "Petrobras", "sanction")

# Native terms by priority, each with its concept.
ARABIC = (
    ("نفط", "oil"), ("غاز", "gas"), ("أوبك", "OPEC"), ("أرامكو", "Aramco"), ("هرمز", "Hormuz"), ("إيران", "Iran"),
    ("مصفاة", "refinery"), ("ديزل", "diesel"), ("بنزين", "gasoline"), ("عقوبات", "sanction"), ("ناقلة", "tanker"), ("الحوثي", "Houthi"),
    ("خام", "crude"), ("برنت", "Brent"), ("غاز مسال", "LNG"), ("الغاز المسال", "LNG"), ("البحر الأحمر", "Red Sea"), ("خط أنابيب", "pipeline"),
    ("أنبوب", "pipeline"), ("بترول", "oil"), ("حقل غاز", "gas"), ("حقل نفط", "oil"), ("بتروبراس", "Petrobras"),
)
RUSSIAN = (
    ("нефт", "oil"), ("газ", "gas"), ("ОПЕК", "OPEC"), ("Газпром", "Gazprom"), ("Роснефт", "Rosneft"), ("Лукойл", "Lukoil"),
    ("санкц", "sanction"), ("дизел", "diesel"), ("бензин", "gasoline"), ("НПЗ", "refinery"), ("танкер", "tanker"), ("Ормуз", "Hormuz"),
    ("СПГ", "LNG"), ("нефтепровод", "pipeline"), ("газопровод", "pipeline"), ("Брент", "Brent"), ("Юралс", "Urals"), ("добыч", "production"),
    ("Иран", "Iran"), ("эмбарго", "sanction"), ("сырая нефт", "crude"),
)
CHINESE = (
    ("石油", "oil"), ("天然气", "gas"), ("原油", "crude"), ("柴油", "diesel"), ("汽油", "gasoline"), ("炼油", "refinery"),
    ("欧佩克", "OPEC"), ("制裁", "sanction"), ("油轮", "tanker"), ("霍尔木兹", "Hormuz"), ("伊朗", "Iran"), ("中石油", "PetroChina"),
    ("中石化", "Sinopec"), ("液化天然气", "LNG"), ("管道", "pipeline"), ("布伦特", "Brent"), ("沙特阿美", "Aramco"), ("胡塞", "Houthi"),
    ("红海", "Red Sea"), ("产量", "production"),
)
HEBREW = (
    ("נפט", "oil"), ("גז", "gas"), ("איראן", "Iran"), ("הורמוז", "Hormuz"), ("בנזין", "gasoline"), ("סולר", "diesel"),
    ("זיקוק", "refinery"), ("מכלית", "tanker"), ("סנקציות", "sanction"), ("ברנט", "Brent"), ("הים האדום", "Red Sea"), ("תימן", "Yemen"),
    ("נפט גולמי", "crude"),
)
SPANISH = (
    ("crudo", "crude"), ("petrolero", "oil"), ("petrolera", "oil"), ("refinería", "refinery"), ("hidrocarburos", "oil"), ("yacimiento", "oil"),
    ("oleoducto", "pipeline"), ("gasóleo", "diesel"), ("sanciones", "sanction"), ("Pemex", "Pemex"), ("Ecopetrol", "Ecopetrol"), ("PDVSA", "PDVSA"),
    ("diésel", "diesel"), ("gasoducto", "pipeline"), ("YPF", "YPF"), ("Vaca Muerta", "Vaca Muerta"), ("buque petrolero", "tanker"),
)
