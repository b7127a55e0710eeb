"""Hand-written posts, one or more per signal, rule and oddity; and mixtures of them."""

import random

POSTS = [
    None, "", "   ", "NO", "no", "No. 5", "kat:3 apt.4", "ano kata",
    "We are trapped in the house after the flood",
    "please help, address 12 Main street", "PLEASE HELP!!! call 0532 123 45 67",
    "rt @user: stuck on the roof, water rising, we are scared", " RT  @x need help at no 5",
    "donation drive, we are collecting: need help, location north hall",
    "need help, drop-off at the school, address here", "need help drop[- ]off address",
    "Enkaz altındayım, konum Hatay Defne mah. ACİL yardım edin", "İMDAT konum burada", "IMDAT konum burada",
    "ımdat! adres yok", "çatıda", "çatıdayız su yükseliyor biz 5 kişi", "ÇATIDAYIZ, SU YÜKSELİYOR",
    "ÇADIR lazım, 12 kişi, çocuklar var, adres Gaziantep Şahinbey Fidanlık mahallesi, deprem",
    "send ambulance 0532 123 4567 https://t.co/abc", "stuck i'm https://a.b",
    "https://a.b/c https://d.e/f HTTPS://G.H need help address", "can't move, fire everywhere",
    "dua ediyoruz, geçmiş olsun", "coordinates 37.06, 37.38 need help now",
    "37.06 37.38 trapped", "37.06  ,  -37.38 trapped", "37.06\t37.38 trapped", "37.06\n, 37.38 stuck",
    "kimse gelmedi, devlet yok", "yardım gelmedi", "kimse yok", "need a boat, evacuate us, storm surge",
    "blanket and insulin, my family is cold", "boat wanted #shelter", "#imdat konum", "a#imdat konum",
    "trapped, send someone", "flooded homes flooded we are drowning", "storm surge", "storm surges",
    "we need help ben biz", "my children need food, fire near", "my child, need water at kat 3",
    "pin: need help", "share location need help", "su lazım, tekne lazım, deprem, konum",
    "başımız sağ olsun", "RABBİM yardım et", "inşallah", "İNŞALLAH",
    "dağıtıyorum yemek var", "kalacak yerim var, arayanlara", "ulaştırabilirim su",
    "Diyarbakır merkez", "İstanbul", "istanbul Kadıköy-Moda", "ISTANBUL'da deprem", "IĞDIR",
    "muş ve Van Erciş", "vana", "Vanda", "Büyük Cadde no 5, Foo sokak yardım lazım", "Köyü yolu köyü",
    "Atatürk Mahallesi yıkıldı", "ATATÜRK MAHALLESİ YIKILDI", "a-b mah", "abc-def mah x",
    "ilk yardım, ilkyardım", "ILK YARDIM", "kan ıyor kanıyor KANIYOR", "nefes alamıyor nefes alamiyor",
    "kuru gıda ve gıda", "nasıl ulaşırım, açık mı?", "112 arayın", "1125", "su yok", "su ihtiyaç var",
    "görme engelli teyze ve bebek", "hamile, GEBE", "yaşlı dede", "çocuklar", "5kişi", "12  people 3 kişi",
    "٣ kişi", "99999999999999999999 kişi", "7 aileyiz", "007 insan", "şu anda yetişin", "acilen", "ACIL",
    "enkaz altında", "enkaz", "kurtarma ekibi", "ulaşılamıyor", "haber alınamiyor", "toplanma alanları",
    "ﬁre in the ﬂat, need help", "Straße address need help", "ＳＯＳ ｎｅｅｄ ｈｅｌｐ", "état need help address",
    "need help address", "need​help address here", "…acil…", "İmdat adres", "ΟΔΟΣ need help no",
    "depremde", "sel_baskını", "sel", "need help_", "1need help no", "😀need help😀 no", "nó",
    "satır1\nBüyük yol mah, x\nson", "Aaaa bbbb cccc sokak", "x" * 70 + " mah", "A" + "b" * 80 + " sokak c",
]


def mixtures(count=300, seed=7):
    rng = random.Random(seed)
    parts = [p for p in POSTS if p]
    glue = [" ", ", ", "\n", ". ", "", "!!! ", "   ", "-"]
    return [rng.choice(glue).join(rng.sample(parts, rng.randint(2, 4))) for _ in range(count)]


ALL = POSTS + mixtures()
