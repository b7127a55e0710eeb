"""Hand-picked posts with the record each has to get.

The records were printed by the labeller once and read against the label rules; they guard what
was found right then.

post, needs, urgency, life threatening, (province, district, neighborhood, address note, confidence
of the place), people, groups, type, confidence; then the evidence: needs, groups, urgency.
"""

RECORDS = [
    ('',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'bilgi', 0.2, [], [], []),
    (None,
     [], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'bilgi', 0.2, [], [], []),
    ('su yok',
     ['su'], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'yardim_talebi', 0.4, ['su yok'], [], []),
    ('kuru gıda ve gıda lazım',
     ['gıda'], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'yardim_talebi', 0.4, ['gıda'], [], []),
    ('ÇADIR lazım, 12 kişi, çocuklar var, adres Gaziantep Şahinbey Fidanlık mahallesi, deprem',
     ['barınma'], 'normal', False, ('Gaziantep', 'Şahinbey', 'Fidanlık', 'DIR lazım, 12 kişi, çocuklar var, adres Gaziantep Şahinbey Fidanlık mahallesi, deprem', 0.8),
     12, ['çocuk'], 'yardim_talebi', 0.5, ['ÇADIR'], ['çocuklar'], []),
    ('Enkaz altındayım, konum Hatay Defne mah. ACİL yardım edin',
     ['arama_kurtarma'], 'critical', True, ('Hatay', 'Defne', 'Defne', 'Enkaz altındayım, konum Hatay Defne mah. ACİL yardım edin', 0.8),
     None, [], 'yardim_talebi', 0.7, ['Enkaz'], [], ['ACİL']),
    ('yardım gelmedi',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'yardim_talebi', 0.2, [], [], []),
    ('kimse gelmedi, devlet yok',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'sikayet', 0.2, [], [], []),
    ('dua ediyoruz, geçmiş olsun',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'duygu/dua', 0.2, [], [], []),
    ('dağıtıyorum yemek var',
     ['gıda'], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'yardim_teklifi', 0.4, ['yemek'], [], []),
    ('görme engelli teyze ve bebek',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, ['bebek', 'yaşlı', 'engelli'], 'bilgi', 0.3, [], ['bebek', 'teyze', 'engelli'], []),
    ('hamile, GEBE',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, ['hamile'], 'bilgi', 0.3, [], ['hamile'], []),
    ('7 aileyiz',
     [], 'normal', False, (None, None, None, None, 0.0),
     7, [], 'bilgi', 0.2, [], [], []),
    ('99999999999999999999 kişi',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'bilgi', 0.2, [], [], []),
    ('12  people 3 kişi',
     [], 'normal', False, (None, None, None, None, 0.0),
     12, [], 'bilgi', 0.2, [], [], []),
    ('istanbul Kadıköy-Moda',
     [], 'normal', False, ('Istanbul', 'Kadıköy-Moda', None, 'istanbul Kadıköy-Moda', 0.8),
     None, [], 'bilgi', 0.2, [], [], []),
    ("ISTANBUL'da deprem",
     [], 'normal', False, ('Istanbul', None, None, "ISTANBUL'da deprem", 0.6),
     None, [], 'bilgi', 0.2, [], [], []),
    ('IĞDIR',
     [], 'normal', False, ('Iğdir', None, None, 'IĞDIR', 0.6),
     None, [], 'bilgi', 0.2, [], [], []),
    ('vana',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'bilgi', 0.2, [], [], []),
    ('Vanda',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'bilgi', 0.2, [], [], []),
    ('muş ve Van Erciş',
     [], 'normal', False, ('Muş', 'Erciş', None, 'muş ve Van Erciş', 0.8),
     None, [], 'bilgi', 0.2, [], [], []),
    ('ATATÜRK MAHALLESİ YIKILDI',
     ['arama_kurtarma'], 'normal', True, (None, None, 'Atatürk', None, 0.3),
     None, [], 'yardim_talebi', 0.4, ['YIKILDI'], [], []),
    ('Büyük Cadde no 5, Foo sokak yardım lazım',
     [], 'high', False, (None, None, None, 'Foo sokak yardım lazım', 0.3),
     None, [], 'yardim_talebi', 0.4, [], [], ['yardım lazım']),
    ('satır1\nBüyük yol mah, x\nson',
     [], 'normal', False, (None, None, 'Yol', 'Büyük yol mah', 0.3),
     None, [], 'bilgi', 0.2, [], [], []),
    ('nefes alamıyor!!!',
     ['tıbbi'], 'critical', True, (None, None, None, None, 0.0),
     None, [], 'yardim_talebi', 0.7, ['nefes alamıyor'], [], ['nefes alamıyor']),
    ('112 arayın',
     ['tıbbi'], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'yardim_talebi', 0.4, ['112'], [], []),
    ('acilen',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'bilgi', 0.2, [], [], []),
    ('ＳＯＳ ｎｅｅｄ ｈｅｌｐ',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'bilgi', 0.2, [], [], []),
    ('need\u200bhelp address here',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'bilgi', 0.2, [], [], []),
    ('enkaz',
     ['arama_kurtarma'], 'normal', True, (None, None, None, None, 0.0),
     None, [], 'yardim_talebi', 0.4, ['enkaz'], [], []),
    ('kurtarma ekibi',
     ['arama_kurtarma'], 'normal', True, (None, None, None, None, 0.0),
     None, [], 'yardim_talebi', 0.4, ['kurtarma'], [], []),
    ('5kişi',
     [], 'normal', False, (None, None, None, None, 0.0),
     5, [], 'bilgi', 0.2, [], [], []),
    ('depremde bina yıkıldı',
     ['arama_kurtarma'], 'normal', True, (None, None, None, None, 0.0),
     None, [], 'yardim_talebi', 0.4, ['yıkıldı'], [], []),
    ('başımız sağ olsun',
     [], 'normal', False, (None, None, None, None, 0.0),
     None, [], 'duygu/dua', 0.2, [], [], []),
]
