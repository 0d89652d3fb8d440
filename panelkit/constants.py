"""Names and word lists that results depend on. Kept as published, in their order."""

# Sub-areas of the area "America": the entities of each.
SUBAREA_PARENT = "America"
SUBAREAS = {
    "North America": [
        "United_States_of_America", "Canada", "Mexico", "Guatemala", "Honduras", "El_Salvador",
        "Nicaragua", "Costa_Rica", "Panama", "Belize", "Cuba", "Jamaica", "Haiti",
        "Dominican_Republic", "Bahamas", "Trinidad_and_Tobago", "Barbados", "Saint_Lucia",
        "Grenada", "Saint_Vincent_and_the_Grenadines", "Antigua_and_Barbuda", "Dominica",
        "Saint_Kitts_and_Nevis",
    ],
    "South America": [
        "Brazil", "Argentina", "Chile", "Colombia", "Peru", "Venezuela", "Ecuador", "Bolivia",
        "Paraguay", "Uruguay", "Guyana", "Suriname", "French_Guiana",
    ],
}

# Short labels used on charts.
SHORT_LABELS = {"United_States_of_America": "USA", "United_Kingdom": "UK"}

# Common name -> official name, tried before the code lookup.
CODE_ALIASES = {
    "Russia": "Russian Federation",
    "Czechia": "Czech Republic",
    "South Korea": "Korea, Republic of",
    "North Korea": "Korea, Democratic People's Republic of",
    "Ivory Coast": "Côte d'Ivoire",
    "Syria": "Syrian Arab Republic",
    "Laos": "Lao People's Democratic Republic",
    "Bolivia": "Bolivia (Plurinational State of)",
    "Venezuela": "Venezuela (Bolivarian Republic of)",
    "Moldova": "Moldova, Republic of",
    "Tanzania": "Tanzania, United Republic of",
    "United States": "United States of America",
    "UK": "United Kingdom",
}

# Raw name -> corrected name, applied before matching (world map).
WORLD_FIXES = {
    "Cases_on_an_international_conveyance_Japan": "Diamond Princess",
    "Bonaire_Saint_Eustatius_and_Saba": "Bonaire, Sint Eustatius and Saba",
    "Congo": "Republic of the Congo",
    "Democratic_Republic_of_the_Congo": "Democratic Republic of the Congo",
    "Cote_dIvoire": "Ivory Coast",
    "Kosovo": "Republic of Kosovo",
    "Saint_Kitts_and_Nevis": "Saint Kitts and Nevis",
    "Saint_Lucia": "Saint Lucia",
    "Saint_Vincent_and_the_Grenadines": "Saint Vincent and the Grenadines",
    "Timor_Leste": "Timor-Leste",
    "United_States_of_America": "United States",
    "United_Republic_of_Tanzania": "Tanzania",
    "Viet_Nam": "Vietnam",
}

# Raw name -> corrected name, applied to what is left unmatched (Europe map).
EUROPE_FIXES = {
    "Cote_dIvoire": "Ivory Coast",
    "Bonaire, Saint Eustatius and Saba": "Caribbean Netherlands",
    "Cases_on_an_international_conveyance_Japan": "Diamond Princess",
}

# Names that are valid besides those of the territory dimension.
WORLD_EXTRA_NAMES = ["Kosovo", "Taiwan", "Vatican City", "Caribbean Netherlands", "Diamond Princess"]
EUROPE_EXTRA_NAMES = [
    "Kosovo", "Congo", "Democratic Republic of the Congo", "Ivory Coast", "Palestine", "Taiwan",
    "Vatican City", "Bonaire, Saint Eustatius and Saba", "Diamond Princess",
]

# Display orders of the run summaries.
VARIANT_ORDER = ["large", "data", "small"]
FRAMEWORK_ORDER = ["spark", "hadoop", "mongo"]
