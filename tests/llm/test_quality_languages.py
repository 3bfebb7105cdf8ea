"""Prose of any language, on one line or broken into short ones, is of no kind; junk of the same words is."""

import random
import textwrap

import pytest

from cartolux.llm import quality as Q

PROSE = {
    "ru": "Вчера мы ещё раз проверили оптическую карту и нашли разрыв между двумя участками. Никто не знает, почему метки там стоят так редко. Может быть, образец был слишком старым, но это придётся проверить завтра.",
    "uk": "Учора ми ще раз переглянули карту й знайшли розрив між двома ділянками. Ніхто не знає, чому мітки там стоять так рідко. Можливо, зразок був надто старий, але це треба перевірити завтра.",
    "pl": "Wczoraj jeszcze raz sprawdziliśmy mapę optyczną i znaleźliśmy przerwę między dwoma odcinkami. Nikt nie wie, dlaczego znaczniki stoją tam tak rzadko. Być może próbka była zbyt stara, jednak trzeba to sprawdzić jutro.",
    "cs": "Včera jsme znovu prošli optickou mapu a našli mezeru mezi dvěma úseky. Nikdo neví, proč tam značky stojí tak řídce. Možná byl vzorek příliš starý, ale to musíme zítra ještě ověřit.",
    "sk": "Včera sme znova prešli optickú mapu a našli medzeru medzi dvoma úsekmi. Nikto nevie, prečo tam značky stoja tak riedko. Možno bola vzorka príliš stará, ale to musíme zajtra ešte overiť.",
    "hr": "Jučer smo još jednom pregledali kartu i našli prazninu između dva odsječka. Nitko ne zna zašto su oznake tamo tako rijetke. Možda je uzorak bio prestar, ali to ćemo sutra provjeriti.",
    "sr": "Јуче смо још једном прегледали мапу и нашли празнину између два одсечка. Нико не зна зашто су ознаке тамо тако ретке. Можда је узорак био престар, али то ћемо сутра проверити.",
    "bg": "Вчера отново прегледахме картата и намерихме празнина между двата участъка. Никой не знае защо белезите там са толкова редки. Може пробата да е била твърде стара, но това ще проверим утре.",
    "fi": "Eilen kävimme kartan läpi uudestaan ja löysimme aukon kahden jakson väliltä. Kukaan ei tiedä, miksi merkit ovat siellä niin harvassa. Ehkä näyte oli liian vanha, mutta se täytyy tarkistaa huomenna.",
    "et": "Eile vaatasime kaardi uuesti läbi ja leidsime kahe lõigu vahelt tühimiku. Keegi ei tea, miks märgid seal nii hõredalt seisavad. Võib-olla oli proov liiga vana, aga seda tuleb homme kontrollida.",
    "lt": "Vakar dar kartą peržiūrėjome žemėlapį ir radome tarpą tarp dviejų atkarpų. Niekas nežino, kodėl žymės ten stovi taip retai. Galbūt mėginys buvo per senas, tačiau tai reikės patikrinti rytoj.",
    "lv": "Vakar vēlreiz pārskatījām karti un atradām spraugu starp diviem posmiem. Neviens nezina, kāpēc zīmes tur stāv tik reti. Varbūt paraugs bija pārāk vecs, taču tas rīt jāpārbauda.",
    "tr": "Dün haritaya bir kez daha baktık ve iki bölüm arasında bir boşluk bulduk. İşaretlerin orada neden bu kadar seyrek olduğunu kimse bilmiyor. Belki örnek çok eskiydi, ama bunu yarın denetlemek gerekecek.",
    "hu": "Tegnap újra átnéztük a térképet, és rést találtunk két szakasz között. Senki sem tudja, miért állnak ott olyan ritkán a jelek. Talán túl régi volt a minta, de ezt holnap ellenőrizni kell.",
    "ro": "Ieri am verificat din nou harta și am găsit un gol între cele două porțiuni. Nimeni nu știe de ce semnele stau acolo atât de rar. Poate că proba era prea veche, dar vom afla mâine.",
    "sv": "Igår gick vi igenom kartan en gång till och hittade en lucka mellan två avsnitt. Ingen vet varför märkena står så glest där. Kanske var provet för gammalt, fast det får vi kontrollera imorgon.",
    "da": "I går gennemgik vi kortet endnu en gang og fandt et hul mellem to afsnit. Ingen ved, hvorfor mærkerne står så spredt der. Måske var prøven for gammel, men det må vi undersøge i morgen.",
    "nb": "I går gikk vi gjennom kartet enda en gang og fant et hull mellom to avsnitt. Ingen vet hvorfor merkene står så spredt der. Kanskje var prøven for gammel, men det får vi sjekke i morgen.",
    "is": "Í gær fórum við aftur yfir kortið og fundum eyðu milli tveggja kafla. Enginn veit hvers vegna merkin standa þar svona strjált. Kannski var sýnið of gamalt, en það þarf að athuga á morgun.",
    "el": "Χθες ελέγξαμε ξανά τον χάρτη και βρήκαμε ένα κενό ανάμεσα στα δύο τμήματα. Κανείς δεν ξέρει γιατί τα σημάδια είναι εκεί τόσο αραιά. Ίσως το δείγμα ήταν πολύ παλιό, όμως αυτό θα το δούμε αύριο.",
    "ar": "راجعنا الخريطة مرة أخرى أمس ووجدنا فجوة بين القسمين. لا أحد يعرف لماذا تقف العلامات هناك متباعدة إلى هذا الحد. ربما كانت العينة قديمة جدا، لكن علينا أن نتحقق من ذلك غدا.",
    "he": "אתמול עברנו שוב על המפה ומצאנו רווח בין שני הקטעים. איש אינו יודע מדוע הסימנים שם כה דלילים. אולי הדגימה הייתה ישנה מדי, אבל את זה נצטרך לבדוק מחר.",
    "fa": "دیروز نقشه را دوباره بررسی کردیم و شکافی میان دو بخش یافتیم. هیچ کس نمی‌داند چرا نشانه‌ها آنجا این قدر کم‌اند. شاید نمونه بسیار کهنه بود، ولی این را باید فردا دید.",
    "hi": "कल हमने नक्शे को फिर से देखा और दो हिस्सों के बीच एक खाली जगह पाई। कोई नहीं जानता कि वहाँ निशान इतने कम क्यों हैं। शायद नमूना बहुत पुराना था, पर यह कल जाँचना होगा।",
    "ta": "நேற்று நாங்கள் வரைபடத்தை மீண்டும் பார்த்து இரண்டு பகுதிகளுக்கு இடையே ஓர் இடைவெளியைக் கண்டோம். அங்கே குறிகள் ஏன் இவ்வளவு குறைவாக உள்ளன என்று யாருக்கும் தெரியவில்லை. மாதிரி மிகவும் பழையதாக இருந்திருக்கலாம், அதை நாளை பார்க்க வேண்டும்.",
    "vi": "Hôm qua chúng tôi xem lại bản đồ và thấy một khoảng trống giữa hai đoạn. Không ai biết vì sao các dấu ở đó lại thưa như vậy. Có lẽ mẫu đã quá cũ, nhưng điều này phải kiểm tra vào ngày mai.",
    "id": "Kemarin kami memeriksa peta itu sekali lagi dan menemukan celah di antara dua bagian. Tidak seorang pun tahu mengapa tandanya begitu jarang. Mungkin sampelnya terlalu tua, tetapi hal ini harus diperiksa besok.",
    "sw": "Jana tuliangalia ramani tena na tukapata pengo kati ya sehemu mbili. Hakuna anayejua kwa nini alama ziko chache pale. Labda sampuli ilikuwa ya zamani sana, lakini itabidi tuangalie kesho.",
    "ka": "გუშინ რუკა კიდევ ერთხელ გადავხედეთ და ორ მონაკვეთს შორის ხარვეზი ვიპოვეთ. არავინ იცის, რატომ დგას ნიშნები იქ ასე იშვიათად. შესაძლოა ნიმუში ძალიან ძველი იყო, მაგრამ ამას ხვალ შევამოწმებთ.",
    "hy": "Երեկ մենք նորից դիտեցինք քարտեզը և երկու հատվածների միջև բաց գտանք։ Ոչ ոք չգիտի, թե ինչու են նշանները այնտեղ այդքան նոսր։ Գուցե նմուշը շատ հին էր, բայց դա պետք է վաղը ստուգել։",
    "cy": "Ddoe edrychon ni ar y map unwaith eto a dod o hyd i fwlch rhwng dwy ran. Nid oes neb yn gwybod pam mae'r marciau mor brin yno. Efallai fod y sampl yn rhy hen, ond rhaid gwirio hynny yfory.",
    "ko": "어제 우리는 지도를 다시 살펴보고 두 구간 사이에서 틈을 발견했다. 표지가 왜 그곳에서 그렇게 드문지 아무도 모른다. 시료가 너무 오래되었을 수도 있지만 내일 확인해야 한다.",
    "ja": "昨日もう一度地図を確かめたところ、二つの区間の間に隙間が見つかった。なぜそこだけ標識がまばらなのかは誰にも分からない。試料が古すぎたのかもしれないが、明日調べる必要がある。",
    "th": "เมื่อวานเราตรวจแผนที่อีกครั้งและพบช่องว่างระหว่างสองช่วง ไม่มีใครรู้ว่าทำไมเครื่องหมายตรงนั้นจึงห่างกันมาก บางทีตัวอย่างอาจเก่าเกินไป แต่ต้องตรวจสอบพรุ่งนี้",
    "terse": "Molecules stretched poorly today. Labels faded quickly under bright light. Second run failed overnight. Nobody restarted imaging until morning. Fresh dye helped slightly. Repeat tomorrow using fewer passes.",
}


def kinds(spark, texts):
    out = Q.judged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "kind").collect()
    return [k for _, k in sorted(tuple(r) for r in out)]


def broken(text, width):
    return "\n".join(textwrap.wrap(text, width))


@pytest.mark.parametrize("shape", [lambda t: t, lambda t: broken(t, 72), lambda t: broken(t, 32), lambda t: t.replace(". ", ".\n\n")], ids=["line", "wide", "narrow", "paragraphs"])
def test_prose_of_any_language(spark, shape):
    got = dict(zip(PROSE, kinds(spark, [shape(t) for t in PROSE.values()])))
    assert {k: v for k, v in got.items() if v is not None} == {}


def test_junk_is_found_without_common_words(spark):
    draw = random.Random(5)
    random_words = " ".join("".join(draw.choice("adefghijklopqrstuwz") for _ in range(draw.randint(3, 11))) for _ in range(60))
    heap = " ".join(draw.choice("map free best optical online scaffold genome cheap version".split()) for _ in range(90))
    heap_ru = " ".join(draw.choice("карта купить онлайн дешево скачать версия быстро".split()) for _ in range(90))
    parts = ["Der erste Lauf war gut.", "Der zweite fiel aus.", "Danach war nichts zu sehen."]
    assert kinds(spark, [random_words, heap, heap_ru, " ".join(parts * 40), "\n\n".join(parts * 40)]) == ["junk"] * 5
