"""Sentences garbled here in known ways must be found and restored; unusual but right text must be left alone."""

import pytest

from tidelog.llm import mojibake as M

SENTENCES = {
    "de": "Die Größe der Datei überschreitet das zulässige Maß für Einträge",
    "fr": "Le fichier a été supprimé après la création du répertoire à l'entrée",
    "es": "La función devuelve el tamaño máximo según la configuración del usuario",
    "pt": "A função não altera a configuração padrão da memória após a exceção",
    "pl": "Ścieżka źródłowa będzie dłuższa niż połączenie, żeby usunąć błąd",
    "cs": "Příliš žluťoučký kůň úpěl ďábelské ódy, když čtení selhalo",
    "tr": "Bağlantı kapalı değilse işlem güncellenir ve çıkış yapılır",
    "ru": "Проверка строки выполняется после чтения файла и закрытия соединения",
    "el": "Το αρχείο δεν βρέθηκε και η εγγραφή απέτυχε μετά τον έλεγχο",
    "zh": "读取配置文件时出现错误，请检查路径是否正确并重新启动服务",
    "ja": "設定ファイルの読み込みに失敗した場合は、この関数を呼び出してください",
    "en": "“It’s the caller’s job” – don’t… close the café’s connection",
}


def wrong(text, written, read):
    """As a reader does that maps undefined bytes to themselves."""
    out = ""
    for b in text.encode(written):
        try:
            out += bytes([b]).decode(read)
        except UnicodeDecodeError:
            out += chr(b)
    return out


@pytest.mark.parametrize("language", SENTENCES)
@pytest.mark.parametrize("read", ["cp1252", "latin-1", "cp1250", "cp437", "mac-roman", "cp1251", "koi8-r"])
def test_utf8_read_as_something_else(language, read):
    text = f"x = 1  # {SENTENCES[language]}"
    assert M.repaired(f"a\n{wrong(text, 'utf-8', read)}\nb") [0] == f"a\n{text}\nb"


@pytest.mark.parametrize("language", ["de", "fr", "pt", "pl", "ru", "en", "zh"])
def test_twice_garbled_and_escaped(language):
    import html

    text = SENTENCES[language]
    twice = wrong(wrong(text, "utf-8", "cp1252"), "utf-8", "cp1252")
    assert M.repaired(twice)[0] == text
    once = wrong(text, "utf-8", "latin-1")
    escaped = "".join(f"&#{ord(c)};" if ord(c) > 0xA0 and i % 3 == 0 else c for i, c in enumerate(once))
    assert html.unescape(escaped) == once and M.repaired(escaped)[0] == text


@pytest.mark.parametrize(
    ("language", "written", "read"),
    [("ru", "cp1251", "cp1252"), ("ru", "koi8-r", "cp1251"), ("ru", "cp1251", "koi8-r"), ("el", "cp1253", "cp1252"), ("zh", "gbk", "cp1252"), ("ja", "cp932", "cp1252"), ("pl", "cp1250", "cp1252"), ("cs", "cp1250", "cp1252"), ("tr", "cp1254", "cp1252"), ("fr", "cp1252", "mac-roman"), ("pt", "cp1252", "mac-roman")],
)
def test_other_encodings(language, written, read):
    text = SENTENCES[language]
    assert M.repaired("// " + wrong(text, written, read))[0] == "// " + text


def test_gbk_reading_of_utf8():
    text = "更新记录关闭连接临时处理"
    assert M.repaired(text.encode().decode("gbk", "replace").replace("�", ""))[1]


@pytest.mark.parametrize("language", SENTENCES)
def test_right_text_is_left_alone(language):
    text = f"def f():\n    # {SENTENCES[language]}\n    return '{SENTENCES[language].upper()}'\n"
    assert M.repaired(text) == (text, [])


@pytest.mark.parametrize(
    "text",
    [
        'assert fix("Ã©") == "é"', 'BAD = "Ã©"\nGOOD = "é"', 'ok("â€™", "’")', r'BAD = "Ã©"', "Ð, ð, Þ and þ: Ðorlákur, það, Ñandú, Øre, Åre", "ÇA VA? ÂGE, CHÂTEAU, AÇÃO, SEÇÃO", "Â, Ê, Î, Ô, Û; À, È, Ù – 12 € «hors taxe»",
        "£ § ¶ © ® ° ± ² ³ µ · ¼ ½ ¾ ¿ × ÷", "‚ ƒ „ … † ‡ ˆ ‰ Š ‹ Œ ™ š › œ", "┌──┬──┐\n│ a │ b │\n└──┴──┘", "├── src\n└── test.py", "╔══╗\n║ x ║", "ВНИМАНИЕ: НЕ МЕНЯТЬ ПОРЯДОК ПОЛЕЙ", "→ ✓ ✗ ★ 🚧 naïve coöperation", "(c) 2015 Zoëlle Šedlok, Iñaxo Dąbrivec, Őrsi Grønquil",
        "a  b c d", "", "plain ascii &amp; more", "x" * 10_000, "日本語", "ок", "5° ± 2 µs ≥ √2", "café", "﻿import os",
    ],
)
def test_unusual_text_is_left_alone(text):
    assert M.repaired(text) == (text, [])


def test_lost_bytes_are_found_but_not_restored():
    text = "Änderung für später".encode("latin-1").decode("utf-8", "replace")
    assert M.repaired(text) == (text, ["lost"])
    assert M.repaired("a � b")[1] == ["lost"] and M.repaired("fa�on")[1] == ["lost"]


def test_part_of_a_text():
    good, bad = SENTENCES["fr"], wrong(SENTENCES["fr"], "utf-8", "cp437")
    text = f"{good}\r\n{bad}\r\n{good} {bad}\n"
    assert M.repaired(text)[0] == f"{good}\r\n{good}\r\n{good} {good}\n"


def test_weak_lines_together():
    lines = ["# naète se", "# pøi ètení", "# vìtší dìlka", "# zpìt úèet"]
    assert M.repaired("\n".join(lines))[1] == ["cp1252>cp1250"]


@pytest.mark.parametrize(
    "bad, right",
    [
        ("caf&Atilde;&copy;", "café"), ("cafÃ© caf&Atilde;&copy;", "café café"), ("Ã© Ã© Ã© ", "é é é "), ("l’Ã©tÃ©", "l’été"), ("&lt;b&gt;caf&amp;Atilde;&amp;copy;&lt;/b&gt;", "&lt;b&gt;café&lt;/b&gt;"),
        ("&#195;&#169;t&#195;&#169;", "été"), ("don&acirc;&euro;&trade;t", "don’t"), ("Gr&#xC3;&#xB6;&#xC3;&#x9F;e &amp; mehr", "Größe &amp; mehr"), ("“Ã©”", "“é”"),
    ],
)
def test_references_and_runs_inside_words(bad, right):
    assert M.repaired(f"x\n{bad}\ny")[0] == f"x\n{right}\ny"


@pytest.mark.parametrize("text", ["caf&eacute; &lt;b&gt;", "&copy; 2020 Foo &mdash; bar", "x &Ntilde;and&uacute; y", "&#1055;&#1088;&#1080;", "a &amp;&amp; b &#39;c&#39;", "&nbsp;&nbsp;", "&Acirc;", "&amp;amp;copy;"])
def test_right_references_stay(text):
    assert M.repaired(text) == (text, [])


def test_labelled_cases():
    """Precision and recall over every sentence, garbled in every way that leaves a trace, among right lines."""
    found = missed = restored = 0
    for text in SENTENCES.values():
        for read in ("cp1252", "latin-1", "cp1250", "cp1251", "cp437", "cp850", "cp866", "koi8-r", "mac-roman"):
            bad = wrong(text, "utf-8", read)
            out, ways = M.repaired(f"ok\n# {bad}\nok")
            found, missed, restored = found + bool(ways), missed + (not ways), restored + (out == f"ok\n# {text}\nok")
    assert missed == 0 and restored / found >= 0.98
    assert not any(M.repaired(f"{a}\n{b}")[1] for a in SENTENCES.values() for b in SENTENCES.values())


def test_a_hidden_document_reaches_the_search(spark):
    df = spark.createDataFrame([(1, "caf&Atilde;&copy;"), (2, "caf&eacute; &amp; tea"), (3, "a &lt; b")], "doc_id bigint, text string")
    assert [(r.doc_id, r.restored) for r in M.garbled(df).collect()] == [(1, "café")]


def test_other_lines_decide_between_ways_alike():
    right = ["Trouvé entrée « où.", "# la clé de l'entrée est répétée", "# données très détaillées après l'été", "# répétez l'exécution du modèle"]
    assert M.repaired("\n".join(wrong(x, "cp1252", "mac-roman") for x in right)) == ("\n".join(right), ["mac-roman>cp1252"] * 4)


def test_results_do_not_hang_on_the_hash_seed():
    import os
    import subprocess
    import sys

    code = "from tidelog.llm import mojibake as M; print([M.cost(x) for x in ('Trouv\u00e9 o\u016f', '\u03b6\u03b2\u03c7 \u043e\u043f', '\u00c3\u00a9\u2022\u00b5')])"
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    seen = {subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "PYTHONHASHSEED": str(i)}, capture_output=True, text=True, check=True).stdout for i in range(4)}
    assert len(seen) == 1


def test_operator(spark):
    bad = wrong(SENTENCES["de"], "utf-8", "cp1252")
    rows = [(1, bad, "x"), (2, SENTENCES["de"], "x"), (3, None, "x"), (4, "", "x"), (5, "ascii", "x"), (1, bad, "x"), (None, bad, "x"), (7, "y" * 300_000 + "\n" + bad, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, restored string")
    got = M.garbled(df).collect()
    assert sorted([r.doc_id for r in got if r.doc_id is not None]) == [1, 1, 7] and len(got) == 4
    assert all(r.restored.endswith(SENTENCES["de"]) and r.ways == ["cp1252>utf-8"] for r in got)
    assert M.garbled(df.limit(0)).count() == 0


@pytest.mark.parametrize("bad, right", [("donâ€™t", "don’t"), ("cafÃ©", "café"), ("GrÃ¶ÃŸe", "Größe")])
@pytest.mark.parametrize("language", ["ru", "el", "zh", "ja"])
def test_one_garbled_word_in_a_right_line(language, bad, right):
    good = f"{SENTENCES[language]} {SENTENCES[language]}"
    assert M.repaired(f"{good} {bad} {good}")[0] == f"{good} {right} {good}"
    assert M.repaired(f'{{"a":"{good}","b":"{bad}"}}')[0] == f'{{"a":"{good}","b":"{right}"}}'


def test_a_legacy_word_in_a_right_line():
    bad = wrong("неверный", "cp1251", "cp1252")
    good = SENTENCES["ja"] * 2
    assert M.repaired(f'{{"a":"{good}","b":"{bad}"}}')[0] == f'{{"a":"{good}","b":"неверный"}}'


def test_right_words_that_form_utf8_by_chance():
    for text in ("Список цен и чем он полезен", "Её нет в списке", "сад, тип, цен, чем, ран"):
        assert M.repaired(text) == (text, [])
