"""Synthetic sentences that the mention model of ``pii`` is trained on.

Sentences are frames with slots, of everyday letters, mail, forms, tables and
notes in four languages; none is taken from a corpus that the model is applied
to.  Slots are filled by generators of invented values; the names come from the
given list and, so that the model learns to trust a context, as often from parts
of listed names put together anew, and from syllables that are in no list.
Frames without a slot of a kind teach what looks like a mention and is none.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass

#: Frames: N name, E email, P phone, I identity number, A address, each in braces; lower-case slots are fillers that are no mentions: w identifier, e eponym, t titled phrase, c organisation, d number, s digit, l long number, h and k hexadecimal, r dotted number, v version, o ordinary capitalised words, u a word in lower case, x an unknown noun after an article or a preposition.
FRAMES = (
    # letters and mail
    "Dear {N},",
    "Dear Mr. {N}, thank you for your letter.",
    "Hi {N}, could you look at this?",
    "Hello {N} - any news?",
    "Best wishes, {N}",
    "Kind regards\n{N}\n{P}",
    "Cheers,\n{N}",
    "From: {N} <{E}>",
    "To: {E}",
    "Cc: {N} <{E}>, {N} <{E}>",
    "On Monday, {N} <{E}> replied:",
    "{N} replied yesterday.",
    "Forwarded by {N} for {N}.",
    "Attn. {N}, {A}",
    "Sent from my phone, {N}",
    "You can write to {E} at any time.",
    "My new mail address is {E}.",
    "E-mail: {E}",
    "email {E}, web page follows",
    "Questions? {E} or {P}.",
    "Unsubscribe by mail to {E};",
    # talk
    "I spoke with {N} this morning.",
    "{N} thinks we are done.",
    "{N} told {N} about it.",
    "Yesterday {N} repaired the fence.",
    "Last week {N} and {N} went home early.",
    "Has anybody seen {N}?",
    "According to {N} it is fine.",
    "{N} does not agree, and neither does {N}.",
    "that is what {N} explained to me",
    "when {N} comes back, ask again",
    "per {N}: keep it",
    "Please give the key to {N}.",
    "It was {N} who found it first.",
    "the same happened to {N} in spring",
    "We owe this to {N}'s patience.",
    "{N}'s desk is empty.",
    "My colleague {N} knows more.",
    "the tester {N} ({E}) was on leave",
    "Our neighbour {N}, {A}, has a copy.",
    "Only {N} can open the door.",
    "Thanks {N}!",
    "thx to {N} and {N}",
    "interview with {N}, part two",
    "Photo: {N}",
    "Text and drawings by {N}",
    "Speaker: Prof. {N}",
    "Chair: Dr. {N}; minutes: {N}",
    "Ms. {N} and Mr. {N} were present.",
    "Present: {N}, {N} and {N}.",
    "(c) {N}",
    "@author {N}",
    "Maintainer: {N} <{E}>",
    "Tested-by: {N} <{E}>",
    "Acked-by: {N}",
    "Assigned to {N}.",
    "Approved: {N}",
    "assignee={N}",
    "* {N}",
    "- {N}, {E}",
    "1. {N}\n2. {N}",
    "/* written by {N} */",
    "// {N}: do not change",
    "# contact {E}",
    "-- {N}",
    "~ {N}",
    "> {N} wrote back",
    "Ask {N}.",
    "Met {N} twice, liked {N} better.",
    "Saw {N} at noon.",
    "Came with {N}. Left with {N}.",
    "{N} wrote a poem; {N} sang.",
    "Then {N} laughed.",
    "Even {N} was late.",
    "Now {N} and {N} share a room.",
    "{N}, {N} and {N} won the race.",
    "is {N} here?",
    "this belongs to {N} now",
    "what belongs to {N} stays with {N}",
    "{N} {u} it.",
    "{u} {N} {u} the {u}.",
    "the {u} of {N} {u}",
    "before {N} {u} and {N} {u}",
    "{u}, {u} and {N}: {u}",
    "We {u} {N} at the {u}.",
    "to {u} {N} {u} {u}",
    # forms and tables
    "Name: {N}",
    "name: {N}; phone: {P}; mail: {E}",
    "Surname, first name: {N}",
    "Customer | {N} | {P} | {E}",
    "{N};{E};{P}",
    "{N}\t{P}",
    "<td>{N}</td><td>{P}</td>",
    "<a href=\"mailto:{E}\">{N}</a>",
    '{"user": "{N}", "mail": "{E}"}',
    '"phone": "{P}"',
    '"owner":"{N}"',
    "Tel. {P}",
    "Phone: {P}",
    "mobile {P}",
    "Fax: {P}, office {P}",
    "Ring {P} after six.",
    "dial {P} and wait",
    "You reach us on {P} or {P}.",
    "the number is {P}, extension {s}",
    "Hotline {P}!",
    "WhatsApp {P}",
    "Her number, {P}, was busy.",
    "Passport no. {I}",
    "passport number {I}, valid for ten years",
    "Social security number: {I}",
    "SSN {I}",
    "ID card {I}",
    "Identity number {I} belongs to {N}.",
    "The copy of {I} must be destroyed.",
    "They noted {I} on the form.",
    "{N} showed passport {I}.",
    "remove {I} from the file",
    "who wrote {I} into the minutes?",
    "national insurance {I}",
    "We live at {A}.",
    "Address: {A}",
    "Visit us at {A}!",
    "Deliver to {N}, {A}.",
    "moved from {A} to {A}",
    "The shop in {A} is closed.",
    "parcels for {A}",
    "Meet me in front of {A}, please.",
    "{A} is the new office.",
    "Billing: {N}, {A}, {P}",
    # German
    "Sehr geehrte Frau {N},",
    "Sehr geehrter Herr {N}, vielen Dank.",
    "Mit freundlichen Grüßen {N}",
    "Gestern hat {N} angerufen.",
    "Das hat {N} schon geprüft.",
    "{N} hat zugestimmt, {N} nicht.",
    "Herr {N} ist im Urlaub.",
    "von {N} geschrieben",
    "Vertretung: {N}, Telefon {P}",
    "Tel.: {P} (abends)",
    "Rufen Sie {P} an.",
    "Meine Mailadresse lautet {E}.",
    "Antwort bitte an {E}, danke.",
    "Wohnhaft in {A}.",
    "Wir treffen uns: {A}",
    "Lieferung nach {A} am Montag",
    "Personalausweis {I}",
    "Reisepass Nr. {I} von {N}",
    "Steuernummer? Nein, {I} ist der Ausweis.",
    "Laut {N} kommt der Zug später.",
    "Dann kam {N}.",
    "Kennt {N} den Weg?",
    "Das Haus gehört {N}.",
    "{N} und {N} wohnen nebenan.",
    "Nur {N} weiß es.",
    # French
    "Bonjour {N},",
    "Cordialement, {N}",
    "Hier, {N} a téléphoné.",
    "{N} a tout vérifié avec {N}.",
    "M. {N} est absent.",
    "Mme {N} viendra demain.",
    "écrit par {N}",
    "D'après {N}, tout va bien.",
    "Téléphone : {P}",
    "Appelez le {P} après midi.",
    "Courriel : {E}",
    "Répondez à {E}, merci.",
    "Domicile : {A}",
    "J'habite {A}.",
    "Livraison chez {N}, {A}, lundi.",
    "Passeport {I}",
    "Le numéro {I} est celui de {N}.",
    "Selon {N}, il pleuvra.",
    "Arrivé avec {N}",
    "{N} et {N} habitent ici.",
    "Voici {N}.",
    "vu par {N}",
    # Spanish
    "Hola {N},",
    "Saludos, {N}",
    "Ayer llamó {N}.",
    "{N} no está de acuerdo con {N}.",
    "El señor {N} vendrá mañana.",
    "Sra. {N}, gracias.",
    "escrito por {N}",
    "Lo dijo {N} ayer.",
    "Teléfono: {P}",
    "Mi móvil es {P}, llámame.",
    "Correo: {E}",
    "Responde a {E}, por favor.",
    "Domicilio: {A}",
    "La tienda de {A} cierra tarde.",
    "Pasaporte {I}",
    "El documento {I} es de {N}.",
    "Según {N}, lloverá.",
    "Llegó {N}",
    "Vino {N} con {N}.",
    "{N} y {N} viven aquí.",
    "Preguntó {N}",
    "Contestó {N}.",
    "Pagó {N}, cantó {N}.",
    "Se lo di a {N}, {A}.",
    "{N}\nMadrid",
    "Chanté par {N}\n{u} {u}",
    "Fragte {N} gestern?",
    # no mentions
    "The {o} {u} the {u}.",
    "Die {x} in {w} {u}.",
    "Der {x} {u}; das {x} {u}.",
    "La {x} {u}, el {x} {u}.",
    "Ohne {x} {u} {u}.",
    "The {x} {u} a {x}.",
    "{o} {u} {u}.",
    "Both {t} and {t} {u} the {u}.",
    "a {e} {u} at {t}",
    "{u} {o}; {u} {t} {u}.",
    "The {e} needs {d} gates.",
    "We replaced the {e} by a {e}.",
    "a {e} in front of {w}",
    "{e} versus {e}",
    "{t} is closed today.",
    "See {t} and {t}.",
    "From {t} to {t} it takes {d} ms.",
    "{t}: {d} of {d} passed",
    "{t}\n{d}. {t}",
    "with {t} it works",
    "The {t} of {c} opens at {s}.",
    "{c} sells it.",
    "made by {c}",
    "ask {c} for a licence",
    "I work for {c}.",
    "Page {d}, table {d}-{d}.",
    "part {d}-{d}-{s}, lot {d}/{d}",
    "id {d}-{d} at {d}.{s} us",
    "{s}-{s}-{s} again",
    "released 2024-0{s}-1{s}, build {l}",
    "0{s}/1{s}/2024 1{s}:3{s}:0{s}",
    "run {l} of {h}",
    "sum {l}, {l} bytes",
    "order {l} was late",
    "Rev {r}",
    "version {r} came out",
    "hash {k}, seed {l}",
    "the hash of it is {k}, not {k}",
    "the sum is {l}, not {l}",
    "commit {k} or commit {l}",
    "Timestamp {l}",
    "since {l} nothing happened",
    "serial {l}; ticket {l}",
    "cherry-pick of {k} into {k}",
    "Prüfsumme {k}, Nummer {l}",
    "le code {k} ou {l} est faux.",
    "el valor {k} o {l} no vale.",
    "do not take {l} or {k} home",
    "{u} {l}",
    "{u} {k}, {u} {l} {u}",
    "it {u} {u} {k}",
    "{u} {l} {u} {k}.",
    "count={l} hash={k}",
    "falls to x. {o} follows.",
    "is set to z. Next {w}.",
    "goes to a. {o}, b. {o}",
    "option b. {o}",
    "checksum {h} differs from {h}",
    "revert {h} please",
    "v{s}.{s}.{d} and {v}",
    "install {w}@{s}.{s}.{s}",
    "{w}@{w} failed",
    "git@{w}:{w}.git",
    "mem[{d}] = 0x{h};",
    "between {d} and {d} at 1{s}.{d} volts",
    "{o} {d} is on.",
    "{o} is not {o}.",
    "If {w} fails, {o} must wait.",
    "{o}, {o} and {o} are missing.",
    "The {o} says nothing.",
    "All {o} were checked before {o}.",
    "Das {o} steht noch aus.",
    "Die {o} und der {o} fehlen.",
    "Ohne {o} geht es nicht.",
    "Le {o} manque. La {o} aussi.",
    "El {o} falta. Una {o} sobra.",
    "A {o} of {w}, Then {o}",
    "Given {w}, The {o} Should Wait.",
    "Nobody knows. Everything else is fine.",
    "Why? Because {o}.",
    "WARNING {o} NOT FOUND IN {w}",
    "if ({w} == {d}) {w} <= {d}'d{s};",
    "module {w} (input {w}, output {w});",
    "Lane {d} and Port {s} of {t}",
    "{d} {o} Road tests",
    "1{s} Way to go",
    "line {d}, column {d}: {o}",
)
TITLES = ("Dr.", "Prof.", "Mr.", "Mrs.", "Ms.", "Herr", "Frau", "M.", "Mme", "Sr.", "Sra.", "Ing.")
_EPONYMS = ("Kogge Stone adder", "Booth multiplier", "Wallace tree", "Moore machine", "Mealy output", "Hamming code", "Johnson counter", "Gray code", "Viterbi decoder", "Reed Solomon code", "Brent Kung adder", "Shannon limit", "Karnaugh map", "Galois field", "Turing machine", "Nyquist rate", "Fourier transform", "Boolean algebra", "Dadda tree", "Von Neumann machine", "Bode plot", "Petri net", "Markov chain", "Bayes rule", "Dijkstra search", "Bloom filter", "Lempel Ziv coder")
_COMPANY_TAILS = ("Labs", "GmbH", "Inc", "Ltd", "Foundation", "Institute", "Systems", "& Sons", "University", "Tower", "AG", "SA", "Group", "Bank", "Museum", "College", "Press", "Hotel")
#: Ordinary words for capitalised phrases that name nobody.
_NOUNS = (
    "Table Section Report Summary Status Error Warning Memory Signal Clock Board Panel Bridge Gate Arbiter Buffer Path Domain Channel Queue Counter Register Window Pointer Reset Power Ground Packet Frame Header Port Switch Driver Stage Unit Core Cache Monitor Checker Reviewer Examiner Student Manager Reader Customer Team Group Meeting Order Invoice Chapter Figure Appendix Version Release Update Design Layout Sheet Paper Letter Answer Question Result Number Index Level Value Rule Test Case Road Street Garden River Winter Summer Monday Friday April "
    "Tabelle Zeile Fehler Speicher Takt Platine Wert Zähler Wellenform Prüfung Abdeckung Messung Freigabe Woche Leitung Änderung Rückmeldung Signal Bericht Schalter "
    "Tableau Ligne Erreur Mémoire Horloge Carte Valeur Mesure Semaine Rapport Signal Tabla Línea Memoria Reloj Placa Medida Semana Informe Señal"
).split()
_LOWER = (
    "keeps sends paints reads drops lifts holds turns makes needs wants uses finds loses opens closes starts ends moves stays looks sounds feels likes trusts visits helps drives walks cooks sings sells buys pays cleans builds breaks checks counts measures compares shares brings carries follows leads waits rests "
    "house table river window answer letter ticket board sample report schedule bench cable socket engine garden school train driver manual drawing budget meeting lunch coffee "
    "sucht findet bringt nimmt kauft fährt bleibt steht liegt Messgerät prüft zahlt wartet trägt cherche trouve apporte prend achète reste attend porte mesure busca trae toma compra queda espera lleva mide"
).lower().split()
_ADJECTIVES = "East North West South Main Upper Lower Left Right First Second Third Next Last Cold Warm Fast Slow Old New Big Small Full Empty Open Closed Late Early Local Global Split Shared Public Hidden Missing Partial Final General Special Central Dual Single Double Total".split()


@dataclass(frozen=True)
class Labelled:
    text: str
    spans: tuple[tuple[int, int, str], ...]


class Fillers:
    """Invented values for the slots."""

    def __init__(self, given: list[str], family: list[str], seed: int):
        self.r = random.Random(seed)
        self.given, self.family = given or ["Alma", "Bruno"], family or ["Castor", "Dahl"]

    def _syllables(self, n: int) -> str:
        return "".join(self.r.choice("b br c d f g gr h j k l m n p r s st t v w z".split()) + self.r.choice(["a", "e", "i", "o", "u", "é", "ö", "ia"]) for _ in range(n)) + self.r.choice(["", "n", "r", "s", "l", "nd", "rt"])

    def _mixed(self, names: list[str]) -> str:
        """The beginning of one listed name with the end of another."""
        a, b = self.r.choice(names), self.r.choice(names)
        return (a[: self.r.randint(2, max(2, len(a) - 2))] + b[self.r.randint(1, max(1, len(b) // 2)) :].lower()).capitalize()

    def _unlisted(self, names: list[str], n: list[int]) -> str:
        if self.r.random() < 0.08:
            return self.r.choice(_NOUNS).capitalize()
        return self._mixed(names) if self.r.random() < 0.5 else self._syllables(self.r.choice(n)).capitalize()

    def name(self) -> str:
        r = self.r
        g = r.choice(self.given) if r.random() < 0.55 else self._unlisted(self.given, [1, 2])
        f = r.choice(self.family) if r.random() < 0.5 else self._unlisted(self.family, [2, 3])
        if r.random() < 0.06:
            f += "-" + r.choice(self.family)
        if r.random() < 0.08:
            f += " " + (r.choice(self.family) if r.random() < 0.6 else self._unlisted(self.family, [2, 3]))
        if r.random() < 0.08:
            g += r.choice([" ", "-"]) + (r.choice(self.given) if r.random() < 0.7 else self._unlisted(self.given, [1, 2]))
        if r.random() < 0.04:
            g += " " + r.choice(self.given) + " " + r.choice(self.given)
        form = r.random()
        if form < 0.12:
            out = f"{f}, {g}"
        elif form < 0.16:
            out = f"{f} {g}"
        elif form < 0.26:
            out = f"{g[0]}. {f}"
        elif form < 0.34:
            out = f"{g} {r.choice('ABCDEFGHIJKLMNOPQRSTUVWYZ')}. {f}"
        elif form < 0.36:
            out = f"{g} {r.choice('ABCDEFGHIJKLMNOPQRSTUVWYZ')} {f}"
        else:
            out = f"{g}{'  ' if r.random() < 0.05 else ' '}{f}"
        case = r.random()
        return out.upper() if case < 0.07 else out.lower() if case < 0.14 else out

    def email(self) -> str:
        r = self.r
        local = r.choice([lambda: r.choice(self.family).lower() + str(r.randint(1, 99)), lambda: r.choice(self.given).lower() + r.choice("._") + r.choice(self.family).lower(), lambda: r.choice(["support", "triage", "rtl-help", "info", "ops"]), lambda: r.choice(self.given).lower()[0] + r.choice(self.family).lower(), lambda: r.choice(self.family).lower() + "+rtl", lambda: r.choice(self.given).lower()])()
        host = [self._syllables(2).replace("é", "e").replace("ö", "o") for _ in range(r.choice([1, 1, 2]))] + [r.choice(["test", "example", "org", "net", "com", "invalid", "de"])]
        at, dot = r.choice([("@", ".")] * 6 + [(" [at] ", " [dot] "), (" (at) ", "."), (" at ", " dot "), ("＠", "."), ("(at)", "(dot)"), ("[at]", ".")])
        out = local + at + dot.join(host)
        return out.upper() if r.random() < 0.06 else out

    def _d(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def phone(self) -> str:
        r, d = self.r, self._d
        return r.choice([lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}.{d(3)}.{d(4)}", lambda: f"{d(3)}.{d(3)}.{d(4)}", lambda: f"+1 {d(3)} {d(3)} {d(4)}", lambda: f"+44 {d(4)} {d(6)}", lambda: f"0{d(4)} {d(6)}", lambda: f"(0{d(2)}) {d(5)} {d(3)}", lambda: f"0{d(2)}/{d(8)}", lambda: f"+49 {d(2)} {d(5)} {d(3)}", lambda: f"0049 {d(2)} {d(5)}-{d(3)}", lambda: f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"0{d(1)}.{d(2)}.{d(2)}.{d(2)}.{d(2)}", lambda: f"+33 {d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"+33{d(3)} {d(6)}", lambda: f"+34 {d(3)} {d(2)} {d(2)} {d(2)}", lambda: f"+34-{d(3)}-{d(2)}-{d(2)}-{d(2)}", lambda: f"{d(3)} {d(6)}", lambda: f"{d(3)} {d(2)} {d(2)} {d(2)}", lambda: f"9{d(8)}", lambda: f"+{d(11)}", lambda: f"0{d(9)}", lambda: f"1-{d(3)}-{d(3)}-{d(4)}"])()

    def identity(self) -> str:
        r, d = self.r, self._d
        up = lambda n: "".join(r.choice("ABCDEHLQTXYZ") for _ in range(n))
        return r.choice([lambda: f"{d(3)}-{d(2)}-{d(4)}", lambda: f"{d(3)} {d(2)} {d(4)}", lambda: f"{up(2)} {d(2)} {d(2)} {d(2)} {up(1)}", lambda: f"{up(2)}{d(7)}", lambda: f"{up(1)}{d(8)}", lambda: f"{up(1)}{d(2)}{up(1)}{d(5)}", lambda: f"{d(8)}{up(1)}", lambda: f"{r.choice('12')} {d(2)} {d(2)} {d(2)} {d(3)} {d(3)} {d(2)}", lambda: f"{d(8)}-{up(1)}", lambda: f"{d(3)}{d(2)}{d(4)}", lambda: f"{r.choice('12')}{d(14)}", lambda: d(r.randint(13, 22)) if r.random() < 0.4 else f"{up(2)}{d(7)}"])()

    def address(self) -> str:
        r, d = self.r, self._d
        no = str(r.randint(1, 420))
        word = lambda: self._syllables(2).capitalize()
        zipped = d(5)
        kind = r.random()
        if kind < 0.5:
            street = f"{no}{r.choice(['', '', 'B'])} {word()}{r.choice(['', ' ' + word()])} {r.choice(['St', 'Street', 'Rd', 'Road', 'Ave.', 'Avenue', 'Blvd', 'Lane', 'Court', 'Terrace', 'Drive', 'Way'])}"
            unit = r.choice(["", "", f", Apt {r.randint(1, 40)}", f" #{r.randint(1, 40)}"])
            return street + unit + r.choice([", ", " - ", "\n"]) + word() + r.choice(["", f", ZZ {zipped}", f" {zipped}"])
        if kind < 0.67:
            street = r.choice([word().lower().capitalize() + r.choice(["straße", "weg", "gasse", "str.", "allee", "platz"]), f"{r.choice(['Am', 'An der', 'Alte', 'Unter den', 'Im'])} {word()}{r.choice(['graben', '', 'tor'])}", f"Alte {r.choice(['Gasse', 'Straße', 'Allee'])}"])
            return f"{street} {no}{r.choice(['', 'a', ' b'])}, {zipped} {word()}"
        if kind < 0.84:
            return f"{no}{r.choice(['', ' bis', ' ter'])}, {r.choice(['rue', 'avenue', 'bd', 'boulevard', 'impasse', 'place', 'chemin'])} {r.choice(['du ', 'de la ', 'des ', 'de '])}{word()}{r.choice(['', '-' + word()])}, {zipped} {word()}"
        return f"{r.choice(['Calle', 'C/', 'Avda.', 'Plaza', 'Paseo', 'Calle del', 'Plaza de la', 'Avda. de los'])} {word()}{r.choice(['', ' ' + word()])} {no}{r.choice(['', ', 2ºB', ', piso 3'])}, {zipped} {word()}"

    def filler(self, slot: str) -> str:
        r, d = self.r, self._d
        if slot == "w":
            return r.choice(["twin", "lazy", "ring", "fast", "rx", "sel", "clk", "tx"]) + "_" + r.choice(["mux", "fifo", "timer", "en", "out", "core"])
        if slot == "e":
            return r.choice(_EPONYMS)
        if slot == "t":
            return " ".join([r.choice(_ADJECTIVES), *([r.choice(_NOUNS)] * r.randint(0, 1)), r.choice(_NOUNS)])
        if slot == "o":
            words = [r.choice(_NOUNS + _ADJECTIVES) for _ in range(r.choice([1, 1, 2, 2, 3]))]
            return " ".join(words).upper() if r.random() < 0.08 else " ".join(words)
        if slot == "c":
            return f"{r.choice(self.family + self.given) if r.random() < 0.7 else self._syllables(2).capitalize()} {r.choice(_COMPANY_TAILS)}"
        if slot == "d":
            return str(r.randint(2, 9999))
        if slot == "s":
            return str(r.randint(1, 9))
        if slot == "l":
            return d(r.choice([6, 8, 9, 9, 10, 10, 11, 13, 16, 19]))
        if slot == "x":
            return self._syllables(r.choice([2, 3, 4])).capitalize()
        if slot == "u":
            return r.choice(_LOWER)
        if slot == "r":
            return ".".join(d(r.choice([1, 2, 3, 4, 5])) for _ in range(r.choice([3, 3, 4])))
        if slot == "k":
            digits = list(d(r.choice([7, 8, 9, 10, 12])))
            for _ in range(r.choice([0, 1, 1, 2])):
                digits[r.choice([0, -1, r.randrange(len(digits))])] = r.choice("abcdef")
            return "".join(digits)
        if slot == "h":
            return "".join(r.choice("0123456789abcdef") for _ in range(r.choice([7, 8, 10, 12])))
        return r.choice(["tbgen", "covmerge", "sv-lint"]) + f"@{r.randint(0, 9)}.{r.randint(0, 30)}.{r.randint(0, 9)}"


_KINDS = {"N": "name", "E": "email", "P": "phone", "I": "id_number", "A": "address"}


def sentences(given: list[str], family: list[str], n: int, seed: int, frames: Sequence[str] = FRAMES) -> list[Labelled]:
    """n labelled texts of one to three sentences of the frames, the same for the same arguments."""
    fill = Fillers(given, family, seed)
    make = {"N": fill.name, "E": fill.email, "P": fill.phone, "I": fill.identity, "A": fill.address}
    out = []
    for i in range(n):
        text, spans = "", []
        chosen = [frames[i % len(frames)], *fill.r.choices(frames, k=fill.r.choice([0, 0, 1, 2]))]
        for frame in chosen:
            more, own, pos = "", [], 0
            while (at := frame.find("{", pos)) >= 0:
                if frame[at + 2 : at + 3] != "}":
                    more += frame[pos : at + 1]
                    pos = at + 1
                    continue
                more += frame[pos:at]
                slot = frame[at + 1]
                value = make[slot]() if slot in make else fill.filler(slot)
                if slot in _KINDS:
                    own.append((len(more), len(more) + len(value), _KINDS[slot]))
                more += value
                pos = at + 3
            more += frame[pos:]
            if not own and fill.r.random() < 0.3:
                more = more.upper()
            text += fill.r.choice([" ", " ", "\n", "\n\n", "\r\n"]) if text else ""
            spans += [(a + len(text), b + len(text), k) for a, b, k in own]
            text += more
        out.append(Labelled(text, tuple(spans)))
    return out
