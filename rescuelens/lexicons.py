"""Word lists, label vocabularies and limits. Data only; nothing here touches Spark.

In the cue tables of the labeller an inner tuple is one *cue* with its spellings; the order
of the cues is the order in which evidence is looked for.
"""

from __future__ import annotations


# --------------------------------------------------------------------------
# Signal word lists. They decide which posts are kept, so they
# have to stay exactly as they are.
# --------------------------------------------------------------------------
HAZARDS_TR = (
    "deprem", "artçı", "yangın", "orman yangını", "sel", "su baskını", "taşkın", "dere taştı",
    "nehir taştı", "fırtına", "kasırga", "hortum", "heyelan", "çamur kayması", "çığ", "tsunami",
    "volkan", "volkanik patlama", "patlama", "göçük",
)
HAZARDS_EN = (
    "earthquake", "aftershock", "wildfire", "fire", "flood", "flooded", "flooding",
    "flash flood", "storm", "hurricane", "tornado", "twister", "landslide", "mudslide",
    "avalanche", "tsunami", "volcano", "eruption", "explosion", "blast", "collapse",
    "storm surge",
)
SOS_TR = (
    "yardım edin", "yardım lazım", "acil yardım", "imdat", "enkazdayım", "enkaz altındayım",
    "göçük altındayım", "mahsur kaldım", "sıkıştım", "nefes alamıyorum", "sesimi duyan var mı",
    "kurtarın", "ambulans gönderin",
)
SOS_EN = (
    "need help", "please help", "urgent help", "help us", "trapped", "under rubble", "stuck",
    "send rescue", "send ambulance", "can't move", "cannot move", "we need help",
)
FLOOD_SOS_TR = (
    "çatıdayız", "çatıda mahsur", "çatıda kaldık", "su yükseliyor", "evleri su bastı",
    "sular bastı", "sular yükseldi", "boğuluyoruz", "bot lazım", "tekne lazım", "tahliye edin",
    "tahliye lazım",
)
FLOOD_SOS_EN = (
    "on the roof", "roof trapped", "water rising", "water level rising", "house flooded",
    "homes flooded", "need a boat", "need boat", "we are drowning", "evacuate us",
)
NEEDS_TR = (
    "su lazım", "yemek", "erzak", "barınak", "çadır", "battaniye", "ısıtıcı", "generator",
    "jeneratör", "powerbank", "bebek maması", "mama", "ilaç", "insülin", "oksijen", "kan lazım",
    "kan ihtiyacı", "sedye", "ambulans", "doktor", "tahliye", "tahliye edin", "bot", "tekne",
)
NEEDS_EN = (
    "need water", "need food", "food needed", "water needed", "shelter", "blanket", "heater",
    "generator", "power bank", "baby formula", "medicine", "meds", "insulin", "oxygen",
    "blood needed", "stretcher", "ambulance", "doctor", "evacuate", "evacuation", "boat",
)
LOCATION_WORDS = (
    "adres", "konum", "lokasyon", "koordinat", "location", "address", "coordinates", "pin",
    "share location",
)
FIRST_PERSON_TR = (
    "ben", "biz", "buradayım", "enkazdayım", "ailem", "annem", "babam", "kardeşim", "çocuğum",
    "eşim",
)
FIRST_PERSON_EN = (
    "i am", "i'm", "we are", "we're", "my family", "my child", "my children", "my mom",
    "my dad",
)
# "drop[- ]off" is matched literally, brackets included.
OFFERS_TR = (
    "bağış", "yardım kampanyası", "yardım topluyoruz", "toplama merkezi", "dağıtıyoruz",
    "ulaştırıyoruz", "kabul ediyoruz", "ihtiyaç listesi", "kampanya", "bağış yapın",
)
OFFERS_EN = (
    "donation", "fundraiser", "collection center", "drop[- ]off", "we are sending",
    "we are collecting",
)
ADDRESS_TOKENS = (
    "mah", "mahalle", "cad", "cade", "cadde", "sok", "sokak", "no", "apt", "apartman", "blok",
    "kat",
)

# URL guard, (characters charged per URL, characters that must remain).
GUARD_LOOSE = (8, 15)
GUARD_TIGHT = (10, 20)
# Languages kept for the tagged corpus.
KEEP_LANGUAGES = ("tr", "en")

# --------------------------------------------------------------------------
# Labeller cues, in evidence order.
# --------------------------------------------------------------------------
NEED_CUES = {
    "medical": (
        ("nefes alamıyor", "nefes alamiyor"),
        ("yaralı", "yaralandı", "kanama", "kanıyor", "kaniyor"), ("ambulans",), ("doktor",),
        ("acil tıbbi",), ("112",), ("kalp",), ("baygın", "bayıldı"),
        ("ilk yardım", "ilkyardım"), ("yanık",), ("kırık",),
    ),
    "search_rescue": (
        ("enkaz",), ("göçük",), ("yıkıldı", "yıkik"), ("sıkıştı",), ("kurtarma", "kurtarın"),
        ("kayıp",), ("haber alınamıyor", "haber alınamiyor"), ("ulaşılamıyor", "ulaşılamiyor"),
    ),
    "evacuation": (
        ("tahliye",), ("boşaltın", "boşaltılması"), ("yangın",), ("sel",), ("tsunami",),
        ("heyelan",),
    ),
    "shelter": (
        ("çadır",), ("barınma", "barınacak"), ("kalacak yer",), ("konaklama",), ("konteyner",),
        ("sığınak",),
    ),
    "water": (
        ("içme suyu",), ("su yok", "su lazım", "su ihtiyaç", "su gerekiyor"), ("temiz su",),
    ),
    "food": (
        ("erzak",), ("yemek",), ("gıda",), ("ekmek",), ("mama",), ("kuru gıda",),
    ),
    "info": (
        ("bilgi",), ("nerede",), ("açık mı",), ("toplanma alanı", "toplanma alanları"),
        ("numara",), ("nasıl ulaşır", "nasıl ulaşırım"), ("durum nedir",),
    ),
}
# "!!!" needs no word boundary and comes last.
CRITICAL_CUES = (
    ("acil",), ("hemen",), ("imdat",), ("nefes alamıyor", "nefes alamiyor"), ("kanama",),
    ("enkaz altında",), ("yangın",), ("hayati",), ("ölmek üzere",),
)
CRITICAL_MARK = "!!!"
HIGH_CUES = (("yardım lazım",), ("yetişin",), ("ihtiyaç",), ("şu anda",))
VULNERABLE_CUES = {
    "infant": (("bebek",), ("yenidoğan",)),
    "child": (("çocuk", "çocuklar"),),
    "elderly": (("yaşlı",), ("teyze",), ("dede",), ("nine",)),
    "pregnant": (("hamile",), ("gebe",)),
    "disabled": (
        ("engelli",), ("tekerlekli",), ("işitme engelli",), ("görme engelli",),
    ),
}
REQUEST_CUES = (
    "yardım", "yardim", "lazım", "lazim", "ihtiyaç", "ihtiyac", "imdat", "kurtarın", "kurtarin",
)
OFFER_CUES = (
    "dağıtıyorum", "dagıtıyorum", "dagitiyorum", "getirebilirim", "götürebilirim",
    "ugraştırabilirim", "ulaştırabilirim", "kalacak yerim var", "arayanlara",
)
COMPLAINT_CUES = (
    "kimse gelmedi", "kimse yok", "devlet yok", "yardım gelmedi", "yardim gelmedi",
)
PRAYER_CUES = (
    "dua", "inşallah", "insallah", "rabbim", "geçmiş olsun", "başımız sağ olsun",
)
# Words that follow a number of people; no word boundary on either side.
PEOPLE_WORDS = (
    "kişi", "kisi", "kişiyiz", "insan", "çocuk", "people", "person", "aileyiz",
)
# Words that make a capitalised phrase an address.
ADDRESS_PHRASE_WORDS = ("mah", "mahalle", "cadde", "sokak", "bulvar", "köy", "köyü")
NEIGHBORHOOD_WORDS = ("mah", "mahallesi")
NOT_A_DISTRICT = (
    "civarı", "yakını", "merkez", "ilçe", "mahalle", "mah", "sokak", "cadde", "bulvar", "bulv",
    "köy", "köyü", "ilçesi",
)
PROVINCES = (
    "Adana", "Adıyaman", "Afyonkarahisar", "Ağrı", "Aksaray", "Amasya", "Ankara", "Antalya",
    "Ardahan", "Artvin", "Aydın", "Balıkesir", "Bartın", "Batman", "Bayburt", "Bilecik",
    "Bingöl", "Bitlis", "Bolu", "Burdur", "Bursa", "Çanakkale", "Çankırı", "Çorum", "Denizli",
    "Diyarbakır", "Düzce", "Edirne", "Elazığ", "Erzincan", "Erzurum", "Eskişehir", "Gaziantep",
    "Giresun", "Gümüşhane", "Hakkari", "Hatay", "Iğdır", "Isparta", "İstanbul", "İzmir",
    "Kahramanmaraş", "Karabük", "Karaman", "Kars", "Kastamonu", "Kayseri", "Kilis", "Kırıkkale",
    "Kırklareli", "Kırşehir", "Kocaeli", "Konya", "Kütahya", "Malatya", "Manisa", "Mardin",
    "Mersin", "Muğla", "Muş", "Nevşehir", "Niğde", "Ordu", "Osmaniye", "Rize", "Sakarya",
    "Samsun", "Siirt", "Sinop", "Sivas", "Şanlıurfa", "Şırnak", "Tekirdağ", "Tokat", "Trabzon",
    "Tunceli", "Uşak", "Van", "Yalova", "Yozgat", "Zonguldak",
)
COUNTRY = "Turkey"
# Characters of context kept before and after a province in the address note.
NOTE_BEFORE, NOTE_AFTER = 40, 60

# Characters that become blanks in the normal form; what stands for digits in a fingerprint.
ODD_SPACES = "\u200b\u00a0"
NUMBER_MARK = "<num>"

# --------------------------------------------------------------------------
# Label vocabularies.
# --------------------------------------------------------------------------
NEED_LABELS = {
    "medical": "tıbbi", "search_rescue": "arama_kurtarma", "evacuation": "tahliye",
    "shelter": "barınma", "water": "su", "food": "gıda", "info": "bilgi",
}
GROUP_LABELS = {
    "infant": "bebek", "child": "çocuk", "elderly": "yaşlı",
    "pregnant": "hamile", "disabled": "engelli",
}
POST_OFFER, POST_REQUEST, POST_COMPLAINT, POST_PRAYER, POST_INFO = ("yardim_teklifi", "yardim_talebi", "sikayet", "duygu/dua", "bilgi")

URGENCY_VALUES = ("critical", "high", "normal", "low")
GROUP_VALUES = ("infant", "child", "elderly", "disabled", "pregnant")
CORRECTED_NEEDS = (
    "search_and_rescue", "ambulance", "first_aid", "food", "water", "shelter", "clothing",
    "logistics", "psychological_support", "transport", "energy",
)
CORRECTED_POST_TYPES = (
    "help_request", "help_offer", "information", "complaint", "emotion/prayer",
)
RUNTIME_POST_TYPES = ("help_request", "information", "emotion/prayer", "complaint")

LABEL_KEYS = (
    "needs", "urgency", "life_threatening", "location", "people_count", "vulnerable_groups",
    "post_type", "confidence",
)
LOCATION_KEYS = (
    "country", "province", "district", "neighborhood", "address_note", "geo_confidence",
)
CLUSTER_KEY = "dedup_cluster_id"

# --------------------------------------------------------------------------
# Readers and the generator.
# --------------------------------------------------------------------------
# Cell contents that a data-frame reader takes for missing.
NULL_CELLS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
TEXT_COLUMN_NAMES = (
    "content", "text", "message", "tweet", "body", "mesaj", "icerik", "içerik",
)
PROMPT_SLOT = "{{SYSTEM_PROMPT}}"
ATTEMPTS_PER_SAMPLE = 3
SYNTHETIC_TARGET = 500

# --------------------------------------------------------------------------
# Own choices.
# --------------------------------------------------------------------------
# Spellings that the offer entry "drop[- ]off" may stand for; used only on request.
DROP_OFF_FORMS = ("drop-off", "drop off")
# Translation of the labeller's values into the corrected vocabulary. The target
# has no equal for medical, evacuation and info; those three are our own choice
# (None drops the value).
NEED_TRANSLATION = {
    "tıbbi": "first_aid", "arama_kurtarma": "search_and_rescue", "tahliye": "transport",
    "barınma": "shelter", "su": "water", "gıda": "food", "bilgi": None,
}
GROUP_TRANSLATION = {
    "bebek": "infant", "çocuk": "child", "yaşlı": "elderly",
    "hamile": "pregnant", "engelli": "disabled",
}
POST_TYPE_TRANSLATION = {
    "yardim_teklifi": "help_offer", "yardim_talebi": "help_request",
    "sikayet": "complaint", "duygu/dua": "emotion/prayer", "bilgi": "information",
}
