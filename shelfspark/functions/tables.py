"""Word lists, units and patterns that decide results. One entry a line or word, in order."""

from __future__ import annotations

ARABIC_DIGITS = ("٠١٢٣٤٥٦٧٨٩٫", "0123456789.")


def _by_word(groups: dict) -> dict:
    """Word -> value of the first group that lists it, in reading order."""
    found: dict = {}
    for value, words in groups.items():
        for word in words:
            found.setdefault(word, value)
    return found


# Units of each retailer's size text.
TAMIMI_UNITS = _by_word({
    ("ml", 1000.0): ("l", "ltr", "litre", "liter", "لتر", "ل"),
    ("ml", 1.0): ("ml", "milliliter", "مل", "ملل"),
    ("g", 1000.0): ("kg", "kilo", "kilogram", "كيلو", "كجم", "كغ", "كغم"),
    ("g", 1.0): ("g", "gram", "grams", "غرام", "جرام", "غم", "جم"),
    ("slices", 1.0): ("slice", "slices", "شريحة", "شرائح"),
    ("triangles", 1.0): ("portion", "portions", "مثلث", "مثلثات"),
    ("pcs", 1.0): ("pc", "pcs", "pack", "can", "cans", "حبة", "حبات", "قطعة", "قطع", "علبة", "علب", "count", "counts"),
})
BINDAWOOD_UNITS = _by_word({
    ("ml", 1000.0): ("l", "ltr", "litre", "liter", "لتر", "ل"),
    ("ml", 1.0): ("ml", "milliliter", "مل", "ملل"),
    ("ml", 10.0): ("cl", "centiliter", "centiliters"),
    ("g", 1000.0): ("kg", "kilo", "kilogram", "كيلو", "كجم", "كغ", "كغم"),
    ("g", 1.0): ("g", "gm", "gram", "grams", "غرام", "جرام", "غم", "جم"),
    ("slices", 1.0): ("slice", "slices", "شريحة", "شرائح"),
    ("triangles", 1.0): ("portion", "portions", "مثلث", "مثلثات"),
    ("pcs", 1.0): ("pc", "pcs", "pack", "can", "cans", "حبة", "حبات", "قطعة", "قطع", "علبة", "علب"),
})
PANDA_UNITS = _by_word({
    ("ml", 1000.0): ("l", "liter", "litre", "ltr"),
    ("ml", 1.0): ("ml", "milliliter"),
    ("g", 1000.0): ("kg", "kilogram", "kilo"),
    ("g", 1.0): ("g", "gm", "gram", "grams"),
    ("pcs", 1.0): ("pcs", "pc", "piece", "pieces"),
    ("slices", 1.0): ("slice", "slices"),
})
DAIRY_UNITS = _by_word({
    ("g", 1.0): ("g", "gm", "gram", "grams", "جرام", "غ"),
    ("g", 1000.0): ("kg", "كيلو جرام", "كجم"),
    ("ml", 1.0): ("ml", "مل"),
    ("ml", 1000.0): ("l", "liter", "litre", "litres", "liters", "لتر"),
    ("pcs", 1.0): ("pcs", "count", "slices", "triangles"),
})
TAMIMI_UNIT_WORDS = (
    "milliliter|kilogram|portions?|triangles?|slices?|liter|litre|ltr|grams?|kilo|pack|cans|can|pcs|ml|kg|gm|pc|l|g|كيلو|جرام|غرام|كغم|"
    "كجم|ملل|لتر|قطع|قطعة|حبات|حبة|علب|علبة|كغ|غم|جم|مل|شريحة|شرائح|مثلث|مثلثات|ل|counts?|count"
)
BINDAWOOD_UNIT_WORDS = (
    "centiliters?|milliliter|kilogram|portions?|triangles?|slices?|litre|liter|grams|kilo|pack|cans|can|pcs|ltr|cl|ml|kg|gm|pc|l|g|كيلو|"
    "جرام|غرام|كغم|كجم|ملل|لتر|قطع|قطعة|حبات|حبة|علب|علبة|كغ|غم|جم|مل|شريحة|شرائح|مثلث|مثلثات|ل"
)
PANDA_UNIT_WORDS = "ml|l|ltr|litre|liter|g|gm|gram|grams|kg|kilogram|pcs|pc"
COUNTED_WORDS = "portions?|triangles?|slices?|حبة|حبات|قطعة|قطع|شريحة|شرائح|مثلث|مثلثات"
TOTAL_UNIT_WORDS = "g|gm|gram|grams|kg|ml|l|ltr|litre|liter|جرام|غرام|جم|غم|كجم|كغ|مل|لتر"
PLUS_WORDS = "slices?|portions?|شرائح|شريحة|مثلث|مثلثات"
QUANTITY_WORDS = "حبة|حبات|قطع|قطعة|pcs|pc|pack|can|cans|علبة|علب|قارورة|قوارير|كيس|صحن"
COUNT_WORDS = "حبة|حبات|قطع|قطعة|pcs|pc|pack|can|cans|علبة|علب|بيض|بيضة|slices?|شرائح|شريحة"
DAIRY_UNIT_WORDS = r"(?:كيلو جرام|liters?|litres?|grams?|جرام|كجم|لتر|مل|kg|gm|ml|g|l)(?![a-zء-ي])"

# Beverages.
FLUFF_WORDS = (
    "fresh", "pure", "premium", "quality", "original", "natural", "classic", "plastic", "bottle", "bot", "tetra",
    "pack", "packet", "box", "can", "cans", "tray", "bag", "pouch", "drink", "product", "taste", "style", "offer",
    "promo", "soft", "carbonated", "flavoured", "flavored", "طازج", "طازجة", "طبيعي", "بلاستيك", "علبة", "قارورة",
    "كرتون", "عرض", "شراب", "مشروب", "غازي",
)
BEVERAGE_SYNONYMS = _by_word({
    "diet_var": ("zero", "diet", "max", "light", "lite", "دايت", "زيرو", "ماكس", "لايت"),
    "regular_var": ("regular", "عادي"),
    "lemon_flavor": ("lemon", "lime", "ليمون"),
    "pom_flavor": ("pomegranate", "رمان"),
    "punch_var": ("punch", "mixed", "مشكل", "فواكه"),
    "orange_flavor": ("orange", "برتقال"),
    "apple_flavor": ("apple", "تفاح"),
    "mango_flavor": ("mango", "مانجو"),
    "berry_flavor": ("berry", "raspberry", "strawberry", "توت", "فراولة"),
    "peach_flavor": ("peach", "خوخ"),
    "mojito_flavor": ("mojito", "موهيتو"),
    "mint_flavor": ("mint", "نعناع"),
    "plain_soda": ("soda", "صودا"),
    "mastic_flavor": ("mastic", "مستكة"),
})
FLAVOURS = (
    "lemon_flavor", "pom_flavor", "punch_var", "orange_flavor", "apple_flavor", "mango_flavor", "berry_flavor",
    "peach_flavor", "mojito_flavor", "mint_flavor", "mastic_flavor",
)
DISCRIMINATORS = (("diet_var", "regular_var"), FLAVOURS, ("sparkling", "still"))
NAME_NOISE = "ml|ltr|liter|litre|pack|bottle|can|cans|drink|beverage|soft|carbonated|fresh|original|offer|promo"

# Dairy and eggs: ordered patterns, the first that fits decides.
BRAND_ALIASES = _by_word({
    "alsafi": ("alsafidanone", "الصافي"),
    "almarai": ("المراعي",),
    "nadec": ("نادك",),
    "nada": ("ندي",),
    "saudia": ("السعوديه",),
    "puck": ("بوك",),
    "kiri": ("كيري",),
    "kraft": ("كرافت",),
    "president": ("بريزيدنت",),
    "saha": ("صحه",),
    "lurpak": ("لورباك",),
    "baladi": ("بلدي",),
    "balade": ("baladefarms",),
    "threecows": ("thethreecows",),
})
FAMILIES = (
    ("eggs", r"\beggs?\b|\bبيض(?:ه)?\b"),
    ("kefir", r"kefir|كفير"),
    ("labneh", r"\blabn[ae]h\b|لبنه"),
    ("cheese", r"cheese|chesse|cheddar|mozzarella|halloumi|\bfett?a\b|gouda|جبن|شيدر|موزاريلا|حلوم"),
    ("butter", r"\bbutter\b|زبده"),
    ("ghee", r"\bghee\b|سمن"),
    ("yogurt", r"yog[uh]?urt|yoghurt|greek dessert|زبادي|روب"),
    ("laban", r"\blaban\b|\bayran\b|kefir|لبن(?!ه)|كفير"),
    ("dessert", r"pudding|custard|dessert|(?:cream|creme) caramel|مهلبيه|كاسترد|كريم كراميل"),
    ("milk", r"\bmilk\b|milkshake|\bshake\b|حليب"),
    ("cream", r"\bcream\b|قشط|كريم"),
)
ATTRIBUTES = {
    "fat": (
        ("skimmed", r"skim|fat[ -]*free|zero fat|0\s*%\s*fat|خالي.*الدسم|منزوع.*الدسم"),
        ("low_fat", r"low[ -]*fat|less fat|reduced fat|\blight\b|\blite\b|قليل.*الدسم"),
        ("full_fat", r"full[ -]*(?:fat|cream)|كامل.*الدسم"),
    ),
    "processing": (("uht", r"\buht\b|long[ -]*life|طويل.*الاجل"), ("fresh", r"\bfresh\b|طازج")),
    "salt": (
        ("unsalted", r"unsalted|no salt|غير مملح|بدون ملح"),
        ("less_salt", r"(?:less|low|reduced|light)[ -]*salt|قليل.*ملح|خفيف.*ملح"),
        ("salted", r"\bsalted\b|مملح"),
    ),
    "egg_size": (
        ("jumbo", r"jumbo|جامبو"),
        ("extra_large", r"extra[ -]*large|\bxl\b|كبير جدا"),
        ("large", r"\blarge\b|كبير"),
        ("medium", r"\bmedium\b|وسط|متوسط"),
        ("small", r"\bsmall\b|صغير"),
    ),
    "color": (("brown", r"\bbrown\b|بني"), ("white", r"\bwhite\b|ابيض|بيضاء")),
    "form": (
        ("shredded", r"shred|grated|مبشور"),
        ("slices", r"slice|sliced|شرائح"),
        ("triangles", r"triangle|مثلث"),
        ("squares", r"squares?|مربع"),
        ("block", r"blocks?|قالب"),
        ("spread", r"spread|قابل.*دهن"),
    ),
    "cheese_type": (
        ("cheddar", r"cheddar|شيدر"),
        ("mozzarella", r"mozzarella|موزاريلا"),
        ("feta", r"\bfett?a\b|فيتا"),
        ("gouda", r"gouda|جودا"),
        ("halloumi", r"halloumi|حلوم"),
        ("parmesan", r"parmesan|parmig|بارميزان"),
        ("edam", r"\bedam\b"),
        ("emmental", r"emmental"),
        ("cottage", r"cottage"),
        ("kashkaval", r"kashkaval|قشقوان"),
        ("cream", r"\bcream\b|كريمي"),
    ),
    "cream_use": (("cooking", r"cooking|طبخ"), ("whipping", r"whipp|خفق"), ("breakfast", r"breakfast|فطور")),
    "milk_source": (
        ("camel", r"\bcamel\b|\b(?:ال)?ابل\b|\bنوق\b"),
        ("goat", r"goat|ماعز"),
        ("plant", r"plant|oat|almond|soy|نباتي"),
    ),
    "texture": (("powder", r"powder|مجفف|بودره"), ("condensed", r"condensed|مكثف"), ("evaporated", r"evaporated|مبخر")),
}
#: Attributes read only within a family.
ATTRIBUTE_FAMILY = {"egg_size": "eggs", "color": "eggs", "cheese_type": "cheese", "form": "cheese", "cream_use": "cream"}
DAIRY_FLAVOURS = {
    "strawberry": r"strawber|strawbery|\bstraw\b|فراول",
    "chocolate": r"choc|شوكولا|شوكولاته",
    "vanilla": r"vanilla|فاني",
    "banana": r"banana|موز(?!اريلا)",
    "mango": r"mango|مانجو",
    "blueberry": r"blueber|توت ازرق",
    "raspberry": r"rasp|توت العليق",
    "blackberry": r"blackber",
    "mixed_berry": r"mixed berr|mixedberr|توت مشكل",
    "peach": r"peach|خوخ",
    "pineapple": r"pineapple|اناناس",
    "coffee": r"coffee|espresso|قهوه",
    "dates": r"\bdates?\b|تمر|تمري",
    "caramel": r"caramel|كراميل",
    "honey": r"honey|عسل",
    "garlic": r"garlic|grlic|ثوم",
    "herbs": r"herbs|اعشاب",
    "chili": r"chili|chilli|حار",
    "olive": r"olive|زيتون",
    "mint": r"\bmint\b|نعناع",
    "lemon": r"lemon|ليمون",
    "biscuit": r"biscuit|cookie|بسكويت",
    "pistachio": r"pistachio|فستق",
    "cherry": r"cherry|كرز",
    "hazelnut": r"hazelnut|بندق",
    "passion_fruit": r"passion\s*fruit",
    "coconut": r"coconut|جوز الهند",
    "red_fruits": r"red fruits?|فواكه حمراء",
    "cucumber": r"cucumber|خيار",
    "parsley": r"parsley|بقدونس",
    "orange": r"orange|برتقال",
}
FEATURES = {
    "omega3": r"omega[ -]*3\b|اومي[غج]ا[ -]*3\b",
    "organic": r"organic|عضوي",
    "lactose_free": r"lactose[ -]*free|خالي.*لاكتوز",
    "protein": r"protein|بروتين",
    "greek": r"greek|يوناني",
    "enriched": r"enriched|fortified|مدعم|غني",
    "spreadable": r"spread|قابل.*دهن",
    "barista": r"barista|باريستا",
    "analogue": r"analogue|imitation|بديل|شبيه",
}
NOT_ORGANIC = r"conventional|non[ -]*organic|غير عضوي"
WITH_LACTOSE = r"with lactose|contains lactose|يحتوي.*لاكتوز"
PLAIN = r"\bplain\b|ساده"
FLAVOURED = r"flavou?red|نكهه"
DAIRY_STOP = (
    "the", "and", "with", "for", "from", "fresh", "pure", "premium", "quality", "original", "natural", "classic",
    "pack", "packet", "box", "tray", "bottle", "plastic", "special", "offer", "price", "full", "fat", "low", "milk",
    "eggs", "egg", "cheese", "yogurt", "yoghurt", "laban", "cream", "g", "ml", "kg", "pcs", "count",
)
TOKEN_ALIASES = _by_word({
    "yogurt": ("yoghurt",),
    "feta": ("fetta",),
    "slices": ("sliced", "slice"),
    "strawberry": ("strawbery",),
    "spread": ("spreadable",),
    "jar": ("aljarra", "jarra"),
    "date": ("dates",),
})

# Produce: keywords of each commodity, searched in this order; the first group goes before the second.
FIRST_ROOTS = _by_word({
    "tomatoes": ("طماطم", "طماطة", "tomato", "tomatoes"),
    "pepper": ("فلفل", "pepper", "peppers", "chili", "chilli", "capsicum"),
    "eggplant": ("باذنجان", "eggplant", "eggplants", "aubergine", "aubergines"),
    "cucumber": ("خيار", "cucumber", "cucumbers"),
    "zucchini": ("كوسة", "zucchini", "zucchinis", "courgette", "courgettes"),
    "green_beans": ("فاصوليا", "green bean", "green beans"),
})
ROOTS = _by_word({
    "banana": ("موز", "banana", "bananas"),
    "dates": ("تمر", "date", "dates", "رطب", "rotab", "rutab", "إخلاص", "ikhlas"),
    "fig": ("تين", "fig", "figs"),
    "mango": ("منجا", "مانجو", "mango", "mangoes"),
    "lemon": ("ليمون", "lemon", "lemons"),
    "orange": ("برتقال", "orange", "oranges"),
    "mandarin": ("يوسفي", "mandarin", "mandarins", "tangerine", "tangerines"),
    "apple": ("تفاح", "apple", "apples"),
    "pear": ("كمثرى", "pear", "pears"),
    "plum": ("برقوق", "بخارى", "plum", "plums"),
    "peach": ("خوخ", "peach", "peaches"),
    "pomegranate": ("رمان", "pomegranate", "pomegranates"),
    "grape": ("عنب", "grape", "grapes"),
    "melon": ("شمام", "melon", "melons"),
    "watermelon": ("حبحب", "بطيخ", "watermelon", "watermelons"),
    "lettuce": ("خس", "lettuce"),
    "corchorus": ("ملوخية", "corchorus", "molokhia", "molokhiya", "molokheya", "jute mallow"),
    "watercress": ("جرجير", "watercress", "rocket", "arugula"),
    "cabbage": ("ملفوف", "cabbage", "cabbages"),
    "spinach": ("سبانخ", "spinach"),
    "pepper": ("فلفل", "pepper", "peppers", "chili", "chilli", "capsicum"),
    "cucumber": ("خيار", "cucumber", "cucumbers"),
    "eggplant": ("باذنجان", "eggplant", "eggplants", "aubergine", "aubergines"),
    "tomatoes": ("طماطم", "طماطة", "tomato", "tomatoes"),
    "pumpkin": ("قرع", "pumpkin", "pumpkins"),
    "zucchini": ("كوسة", "zucchini", "zucchinis", "courgette", "courgettes"),
    "okra": ("بامية", "okra"),
    "green_beans": ("فاصوليا", "green bean", "green beans", "bean", "beans"),
    "carrots": ("جزر", "carrot", "carrots"),
    "garlic": ("ثوم", "garlic"),
    "onion": ("بصل", "onion", "onions"),
    "olives": ("زيتون", "olive", "olives"),
    "potatoes": ("بطاطس", "بطاطا", "potato", "potatoes"),
    "corn": ("ذرة", "corn", "sweet corn", "sweetcorn"),
    "parsley": ("بقدونس", "parsley"),
})
PREMIUM = ("organic", "عضوي", "عضوية", "hydroponic", "مائي", "هيدروبونيك", "baby", "شيري", "صغير")
BUNDLE_ROOTS = ("corchorus", "watercress", "spinach", "parsley")
#: Words that tell a variant, of a product's and of an anchor's text.
PRODUCE_WORDS = {
    "sliced": (("slice", "slices", "sliced", "شرائح", "مقطع", "قطع", "tray", "صحن"), ("slice", "slices", "شرائح", "مقطع")),
    "apple_red": (("red", "أحمر", "احمر", "royal gala", "gala", "رويال جالا"), ("red", "احمر", "أحمر")),
    "apple_yellow": (("yellow", "أصفر", "اصفر", "golden", "جولدن"), ("yellow", "اصفر", "أصفر", "golden")),
    "apple_green": (("green", "أخضر", "اخضر", "granny", "جراني"), ("green", "اخضر", "أخضر")),
    "chili": (("chili", "chilli", "hot", "حار", "شطة", "حراق"), ("chili", "chilli", "حار", "شطة")),
    "sweet": (("sweet", "bell", "بارد", "رومي", "capsicum"), ("sweet", "bell", "بارد", "رومي")),
    "onion_red": (("red", "أحمر", "احمر", "حمراء"), ("red", "أحمر", "احمر")),
    "onion_white": (("white", "أبيض", "ابيض", "بيضاء"), ("white", "أبيض", "ابيض", "مستورد")),
    "onion_green": (("green", "spring", "أخضر", "اخضر"), ("green", "spring", "أخضر", "اخضر")),
}
PINK_LADY = ("pink lady", "بينك ليدي")
LOCAL_WORDS = ("محلي", "وطني", "local", "ksa", "سعودي")
IMPORTED_WORDS = ("مستورد", "imported")
BUNDLE_UNITS = ("bundle", "حزمة", "ربطة")
BUNDLE_WORDS = ("حزمة", "ربطة", "bundle", "bunch")
MARKS = "ً-ٟ"
