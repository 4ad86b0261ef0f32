"""Word lists, patterns and tables that results depend on, one entry to a line, in their natural order."""

from __future__ import annotations


def lines(text: str) -> list[str]:
    """The entries of a block."""
    return text.strip("\n").split("\n")

#: Function words of English and German.
SMALL_WORDS = lines(
    r"""
a
an
and
as
at
by
for
from
in
into
of
on
or
the
to
with
vs
am
auf
aus
bei
das
dem
den
der
des
die
ein
eine
einem
einen
einer
eines
fuer
fur
im
ins
mit
nach
ohne
und
vom
von
vor
zum
zur
zu
uber
ueber
rund
ums
"""
)

#: Words that count as known in titles.
BOOSTED_WORDS = lines(
    r"""
age
ages
air
alone
anno
battlefield
berlin
call
captain
chaos
clancy
company
conflict
conquer
dutchmans
empires
enemy
ghost
gold
heroes
island
journey
kingdom
knight
legend
lost
mord
mythology
need
oblivion
pacific
pirates
project
quake
rainbow
recon
rush
sacred
sands
show
simon
soccer
speed
sparta
story
stronghold
territory
the
toledo
underworld
war
wars
wheelsof
world
worldin
x
zoo
"""
)

#: Words whose presence inside a token hints at a glued title.
SEGMENT_HINTS = lines(
    r"""
of
the
and
und
der
die
das
des
im
in
on
von
auf
zum
zur
with
for
durch
nach
ums
"""
)

#: Whole titles that are disc noise.
NOISE_TITLES = lines(
    r"""
werbung
filme
topdemos
online spiel
onlinespiel
online spiele
loesung
loesungsbuecher
browsergames
browsergames small
demo shield launch
reserved for status bar
reserved for statusbar
code aktionen
codeaktionen
jahresinhalt cbs
kinofilm
kinovorschau
cheats
"""
)

#: Disc noise.
NOISE_PATTERNS = lines(
    r"""
^chk\b
^die fischverladestelle$
^kreska(?:\b|$)
^(?:plus|minus) schwierigkeitsgrad$
^schwierigkeitsgrad$
"""
)

#: Guides and media.
GUIDE_PATTERNS = lines(
    r"""
komplettl
loesungs
lösungs
\btrailer\b
trailerliste
bildschirmhintergr
bildschirmschoner
screenmate
spieltricks
spieltipps
hintergr
wallpaper
kinofilm
kinovorschau
\bcheats\b
"""
)

#: Editors and kits.
EDITOR_PATTERNS = lines(
    r"""
\beditor\b
leveleditor
map editor
world editor
construction set
\bsdk\b
mod sdk
modtool
mod kit
toolkit
karten editor
"""
)

#: Utilities.
UTILITY_PATTERNS = lines(
    r"""
\.net framework
^net ?framework
^netframework
webde.*surfer
^skype\b
^skype\d
team speak
^teamspeak
\bfraps\b
\bxfire\b
ccleaner
backup
optimizer
firewall
true image
drive image
\bdivx\b
sharedrive
passwort safe
passworte
phys ?x
radeon
nvidia
ashampoo
cobian
comodo
acronis
tcp optimizer
secunia
sandra
spybot
dsl manager
easytoolz
chk tooltips
tooltip handler
aisuite
smart surfer
norton
sound blaster
mc afee
\bstinger\b
\bdisk defrag\b
\beasy bcd ?\d*
\breg cleaner\b
\bstar ?force\b.*\bvista\b
\btweak vi\b
\bvista boot pro ?\d*
"""
)

#: Expansions.
EXPANSION_PATTERNS = lines(
    r"""
\badd[ -]?on\b
\baddon\b
\bexpansion pack\b
\bmission pack\b
"""
)

#: Modifications.
MOD_PATTERNS = lines(
    r"""
\bmod\b
\btotal conversion\b
"""
)

#: Columns of a reference match.
MATCH_FIELDS = lines(
    r"""
canonical_title
canonical_slug
match_status
match_confidence
match_method
match_source
match_source_url
match_fetched_at
entity_type
release_year
wikipedia_url
wikidata_id
wikidata_url
categories
genres
themes
category_source
category_source_url
category_fetched_at
category_confidence
rating_value
rating_scale
rating_count
rating_source
rating_url
rating_fetched_at
rating_confidence
metadata_sources
notes
"""
)

#: Normalized titles that are dropped.
BAD_EXACT = lines(
    r"""
000 000
100 spiele
082009
82009 normal
abbrechen
abfrage
aktualisieren
alternativ
aufl sung
cancel
cdstart
common
daten
details
dll
files
gewicht
icon
internet
karte
kraft
kurzversionen
laden
layout
loader
logo
manual
misc
normal
none
obscure demo
options
overlays
partikel
patch
readme
serverliste
servername
shell exec
sounds
spielart
spieler
spielername
sonstiges
start
swingcd
swingrun
updates
user1
visit play hef com
wichtige informationen
"""
)

#: Parts of titles that are dropped.
BAD_PARTS = [
    " bonus ",
    "track ",
    " autorun",
    "adobe",
    "acrobat",
    "antivir",
    "anti vir",
    "auto run",
    "catalyst",
    "cbs ",
    "cd icon",
    "desktop",
    "direct x",
    "directx",
    "driver",
    "einstellungen",
    "einzelspieler",
    "eula",
    "explorer",
    "folder",
    "handbuch",
    "hilfe",
    "hyperlink",
    "icon",
    "inst ",
    "install",
    "internet explorer",
    "jagdtiger",
    "layerchange",
    "liesmich",
    "manual",
    "media center",
    "media player",
    "mehrspieler",
    "menu",
    "ms internet explorer",
    "options",
    "patch",
    "player",
    "projectfreedom",
    "read me",
    "reader",
    "server",
    "setup",
    "shell exec",
    "span",
    "spellforce2 2 sw",
    "swing",
    "tobicon",
    "treiber",
    "visit ",
    "windows media player",
    "winsock",
    "zone alarm",
    "tuner",
]

#: Parts of manifest names that are dropped.
MANIFEST_PARTS = lines(
    r"""
track
manual
readme
liesmich
handbuch
autorun
menu
setup
install
patch
files
common
layout
sounds
desktop
folder
logo
directx
direct x
loader
eula
dll
updates
misc
language
overlays
icon
"""
)

#: Normalized titles that are not published.
STRICT_EXACT = lines(
    r"""
aisuite
alpha 1
alpha 2
alpha calosc
ati pr fsoftware
ati radeon
ati radeon notebook
ammo in mag
background led weight
browsergames small
computerbild
computerbild spiele
computer bild spiele
ageia phys x system software
ageia phys xsystem software
ageia physx system software
alle meine passworte
allemeine passworte
ip hinzuf gen
johnnie walker moorhuhnjagd
l schen
l sungb cher
l sungsb cher
loesungsbuecher
lautst rke musik
lautst rke sfx
m chten sie das spiel verlassen
minus aufl sung
niedrigaufl sende texturen
nvidia phys x system software 8 04
nvidia phys xsystem software80425
plus aufl sung
prim r
trailer
trailer01
trailer02
trailerliste
secunia personal software inspector
si software sandra 2005 lite
tcp optimizer
tutorial wasserk hlung
trailer
trailer01
trailer02
trailerliste
wybierz parametry instalacyjne
www link
www link
zur ck zum spiel
zur cksetzen
zurueck
aukeratu instalazioa egiteko hizkuntza
"""
)

#: Parts of titles that are not published.
STRICT_PARTS = [
    "acronis",
    "abylon",
    "aware",
    "adobe",
    "ashampoo",
    "reader",
    "windows",
    "media",
    "antivir",
    "player",
    "driver",
    "explorer",
    "spiele",
    "computerbild",
    "computer bild",
    "manual",
    "readme",
    "handbuch",
    "eula",
    "patch",
    "layerchange",
    "icon",
    "logo",
    "keysafe",
    "sharedrive",
    "logon",
    "prüfsoftware",
    "prufsoftware",
    "tuner",
    "endif",
    "hyperlink",
    "span",
    "browsergames",
    "button ",
    "inspector",
    "nvidia ",
    "phys x",
    "physx",
    "radeon",
    "sound blaster",
    "sandra",
    "drive image",
    "loesungsbuch",
    "loesungsbuecher",
    "lösungsbuch",
    "lösungsbücher",
    "bildschirmhintergr",
    "bildschirmschoner",
    " trailer",
    "passworte",
    "trailerliste",
    "game trailer",
    "dvdvideo",
    "tutorial",
    "hizkuntza",
    "instalazio",
    "instalacyjne",
    "www link",
]

#: Path parts that name no title.
GENERIC_SEGMENTS = lines(
    r"""
autorun
bonus
cd
cd1
cd2
data
demo
demos
disk
disk1
disk2
driver
drivers
extras
game
games
install
launcher
menu
patch
patches
play
progs
program
programme
programs
setup
software
start
starter
support
tools
treiber
uninstall
update
utils
vollv
"""
)

#: Further words that name no title.
GENERIC_WORDS_MORE = lines(
    r"""
bild
cbs
cd
computer
coverdisc
covermount
demo
dvd
edition
gold
inhalt
issue
launcher
magazine
setup
silber
spiele
platin
shareware
trial
"""
)

#: Titles of the magazine itself.
GENERIC_TITLES = lines(
    r"""
computer bild
computer bild spiele
computer bild spiele cd
computer bild spiele dvd
coverdisc
covermount
issue
magazine
"""
)

#: Files that may hold titles.
METADATA_SUFFIXES = lines(
    r"""
.inf
.ini
.html
.htm
.txt
.nfo
"""
)

#: Disc images in one file.
IMAGE_SUFFIXES = lines(
    r"""
.bin
.cdr
.dmg
.img
.iso
.mdf
.nrg
.toast
"""
)

#: States of an archive that need no further run.
TERMINAL_STATUSES = lines(
    r"""
ok
download_failed
extract_failed
mount_failed
hash_failed
"""
)

#: Literals that must not be published.
PERSONAL_LITERALS = lines(
    r"""
/Users/
/home/
.takopi/
BEGIN PRIVATE KEY
BEGIN OPENSSH PRIVATE KEY
ssh-ed25519 AAAA
"""
)

#: Known noise in published titles.
KNOWN_NOISE = [
    "zurueck",
    "zur ck ",
    "bildschirmhintergr",
    "bildschirmschoner",
    "lautst rke",
    "aufl sung",
    "pr fsoftware",
    "l sungsb",
    "l sungb",
    "loesungsbuch",
    "m chten sie das spiel verlassen",
    "ip hinzuf gen",
    "browsergames",
    "passworte",
    "physx",
    "phys x",
    "radeon",
    "sandra",
    "tutorial",
]

#: Parts of malformed titles.
SAMPLE_MALFORMED = [
    "ageof ",
    " fuelof ",
    "bseunterder",
    "unddanngabskeinesmehr",
    "legendender",
    "emmoandthe",
    "komplettlsung",
    "stundeder",
    "herzdes",
    "kampfder",
    "dieheiligen",
    "knig",
    "spinnfischenin",
    "dutchmans",
]

#: Titles known to be right.
SAMPLE_KNOWN = lines(
    r"""
knights of honor
"""
)

#: Parts of resource and tool names.
SAMPLE_DROP = lines(
    r"""
bildschirmhintergr
bildschirmschoner
passworte
physx
phys x
radeon
software
tutorial
instal
"""
)

#: Normalized title, then the title it is repaired to.
TITLE_REPAIRS = dict(
    x.split(" = ", 1)
    for x in lines(
        """
2 ritter auf der suche nach der hinrei enden herzelinde = 2 Ritter - Auf der Suche nach der hinreißenden Herzelinde
adash stadt der magie kapitel11 = Adash - Stadt der Magie - Kapitel 11
apassionata die galanacht der pferde = Apassionata - Die Galanacht der Pferde
alone in the dark komplettl sung = Alone in the Dark Komplettlösung
ati pr fsoftware = ATI Prüfsoftware
baldur s gate 2 schatten von amn = Baldur's Gate 2 - Schatten von Amn
baldur s gate 2 thron des bhaal = Baldur's Gate 2 - Thron des Bhaal
baldur s gate compilation = Baldur's Gate - Compilation
baldur s gate legenden der schwertk ste = Baldur's Gate Legenden der Schwertküste
bildschirmhintergr nde = Bildschirmhintergründe
call of duty 4 modern warfare = Call of Duty 4 - Modern Warfare
battlefield2142v150 = Battlefield 2142
codename panzers cold war = Codename Panzers - Cold War
codename panzers phase2v108 = Codename Panzers Phase 2
command conquer gener le die stunde null = Command & Conquer Generäle Die Stunde Null
command conquer alarmstufe rot 3v 1 = Command & Conquer - Alarmstufe Rot 3 v 1
command conquer3 tiberium warsv108 kane edition = Command & Conquer 3 Tiberium Wars Kane Edition
command conquer3 tiberium warsv108 standard edition = Command & Conquer 3 Tiberium Wars Standard Edition
command conquer3 tiberium warsv108 kane = Command & Conquer 3 Tiberium Wars Kane Edition
command conquer3 tiberium warsv108 standard = Command & Conquer 3 Tiberium Wars Standard Edition
crazy machines 2 cm = Crazy Machines 2
das geheimnis der vergessenen h hle = Das Geheimnis der vergessenen Höhle
das schwarze auge drakensang = Das Schwarze Auge - Drakensang
das verm chtnis testament of sin = Das Vermächtnis - Testament of Sin
desperados 2 cooper s revenge = Desperados 2 - Cooper's Revenge
das erbe der k nige = Das Erbe der Könige
die gilde 2 venedig v 3 = Die Gilde 2 - Venedig v 3
die legenden und m rchen von ash kale 1 = Die Legenden und Märchen von Ash'kale 1
die siedler 6 aufstieg eines k nigreichs = Die Siedler 6 Aufstieg eines Königreichs
die siedler aufstieg eines k nigreichs = Die Siedler Aufstieg eines Königreichs
die siedler 2 die n chste generation = Die Siedler 2 Die nächste Generation
die siedler das erbe der k nige = Die Siedler Das Erbe der Könige
dikowsk ru land = Dikowsk, Rußland
diverse bildschirmhintergr nde = Diverse Bildschirmhintergründe
dreamlords the re awakening = Dreamlords - The Re Awakening
erbe der k nige = Erbe der Könige Demo
fu ball manager08 = Fußball Manager 08
fu ball manager09 = Fußball Manager 09
fu ball manager2008v 8 0 = Fußball Manager 2008 v 8 0
fuball manager2008v802 = Fußball Manager 2008
garry die schmei fliege = Garry die Schmeißfliege
grand ages rome = Grand Ages - Rome
gta 4 komplettl sung = GTA 4 Komplettlösung
icewind dale herz des winters = Icewind Dale - Herz des Winters
ip hinzuf gen = IP HINZUFÜGEN
k nige der wellen = Könige der Wellen
kings bounty the legend = King's Bounty - The Legend
l schen = Löschen
l sungb cher = Lösungsbücher
l sungsb cher = Lösungsbücher
lautst rke musik = Lautstärke Musik
lautst rke sfx = Lautstärke SFX
lego indiana jones die legend ren abenteuer = Lego Indiana Jones Die legendären Abenteuer
m llabfuhr simulator2008 = Müllabfuhr Simulator 2008
m chten sie das spiel verlassen = Möchten Sie das Spiel verlassen?
mercedes clc dream test drive = Mercedes CLC Dream - Test Drive
meine tierklinik l wenbaby = Meine Tierklinik Löwenbaby
minus aufl sung = minus Auflösung
moorhuhn schatzj ger 3 = Moorhuhn Schatzjäger 3
need for speed underground v 1 1 = Need for Speed - Underground v 1 1
nibiru der bote der g tter = Nibiru Der Bote der Götter
niedrigaufl sende texturen = Niedrigauflösende Texturen
nikopol die r ckkehr der unsterblichen = Nikopol Die Rückkehr der Unsterblichen
post mortem l sungsbuch = Post Mortem + Lösungsbuch
plus aufl sung = plus Auflösung
prim r = Primär
quake4v142 = Quake 4
radsport manager pro2007v1010 = Radsport Manager Pro 2007
rainbow six vegas2v103 = Rainbow Six Vegas 2
r ckkehr zur insel = Rückkehr zur Insel
sacred 2 fallen angel = Sacred 2 - Fallen Angel
sacred 2 fallen angel v 2 34 0 = Sacred 2 - Fallen Angel v 2 34 0
sherlock holmes jagt ars ne lupin = Sherlock Holmes jagt Arsène Lupin
sherlock holmes die spur der erwachten remastered = Sherlock Holmes - Die Spur der Erwachten - Remastered Edition
sid meier s civilization 4 fall from heaven 2 0 = Sid Meier's Civilization 4 - Fall from Heaven 2 0
siedler das erbe der k nige = Siedler Das Erbe der Könige
stalkerv10003v10004v10005 = STALKER
stronghold2v14 = Stronghold 2
supreme commander forged alliance v 1 5 3596 auf = Supreme Commander Forged Alliance
supreme commander forged alliance v 1 5 3596 auf v 1 5 = Supreme Commander Forged Alliance
supreme commander forged alliancev153596auf = Supreme Commander Forged Alliance
supreme commander forged alliancev153596aufv153599 = Supreme Commander Forged Alliance
syberia 2l sungsbuch = Syberia 2 + Lösungsbuch
tom clancys ghost recon advanced warfighter2v102 = Tom Clancy's Ghost Recon Advanced Warfighter 2
tom clancys ghost recon advanced warfighter2v104 = Tom Clancy's Ghost Recon Advanced Warfighter 2
tomb raider underworld v 1 = Tomb Raider - Underworld v 1
tomb raider underworld = Tomb Raider - Underworld
unreal tournament3v12 = Unreal Tournament 3
turbo strau = Turbo Strauß
tutorial wasserk hlung = Tutorial: Wasserkühlung
velaya geschichte einer kriegerin 1 = Velaya - Geschichte einer Kriegerin 1
waldmeister sause edelwei = Waldmeister Sause Edelweiß
wickie ylvi ist entf hrt = Wickie Ylvi ist entführt
zur ck zum spiel = ZURÜCK ZUM SPIEL
zur cksetzen = Zurücksetzen
"""
    )
)

#: Whole words, then what they are repaired to, applied in this order.
TOKEN_REPAIRS = [
    tuple(x.split(" = ", 1))
    for x in lines(
        """
Ageof = Age of
Needfor = Need for
Rageof = Rage of
Riseofa = Rise of a
Dieheiligen = Die heiligen
Updateauf = Update auf
City Life Update auf City Life 2008 = City Life & Update auf City Life 2008
Holmesjagt = Holmes jagt
Arsne = Arsène
Legendender = Legenden der
Schwertkste = Schwertküste
Command Conquer = Command & Conquer
Sim on the = Simon the
Chaosistdashalbe = Chaos ist das halbe
Ordendes = Orden des
Knigreichdes = Knigreich des
Endeder = Ende der
Rushfor = Rush for
Sandsof = Sands of
Kingdomof = Kingdom of
Gameofthe = Game of the
Beyondthe = Beyond the
Worldin = World in
Swordof = Sword of
Wheelsof = Wheels of
"""
    )
]

#: Rank of a source kind.
SOURCE_RANKS = {
    "vollversion-fullversion": 8,
    "vollversion-description": 7,
    "vollversion-title": 6,
    "archiveorg-ocr": 6,
    "archiveorg-description": 5,
    "archiveorg-subject": 4,
    "archiveorg-note": 4,
    "archiveorg-title": 3,
    "redump-title": 2,
    "redump-snippet": 1,
    "disc-metadata-value": 2,
    "disc-metadata-command": 2,
    "disc-manifest-path": 1,
    "disc-exe-parent": 1,
    "disc-exe-name": 0,
}

#: Rank of a confidence; ordered content kinds with the words that mark a section; titles too general to
#: stand for an unnamed entity.
CONFIDENCE_RANKS = {"high": 3, "medium": 2, "low": 1}
SECTION_MARKERS = [
    ("full_version", r"\b(vollversion(?:en)?|full\s*version(?:s)?)\b"),
    ("demo", r"\b(demo|demos)\b"),
    ("bonus", r"\b(bonus|extras?)\b"),
    ("unknown", r"\b(beinhaltet|inhalt|contents|spiele|cd-?inhalt|dvd-?inhalt)\b"),
]
PLAIN_QID_TITLES = ["air taxi", "astro man", "the show", "startzeit"]
GAME_MARKERS = ["video game", "computer game", "videogame", "videospiel", "computerspiel"]
NON_GAME_MARKERS = ["film", "movie", "album", "song", "single", "novel", "book", "tv series", "television", "character", "magazine"]
#: End-anchored patterns of disc descriptors and versions, applied in this order (ignoring case).
DESCRIPTOR_SUFFIXES = [
    r"\((?:add[ -]?on\s+)?demo\)$",
    r"\((?:full\s*version|vollversion)\)$",
    r"\b(?:full\s*version|vollversion|bonus|extras?)\b$",
    r"\bdemo\b$",
]
VERSION_SUFFIXES = [
    r"\bversion\s*[0-9][0-9a-z ._-]*$",
    r"\bupdate\s*[0-9][0-9a-z ._-]*$",
    r"\bv\s*[0-9][0-9a-z ._-]*$",
    r"(?<=[A-Za-z]{4})v\s*[0-9][0-9a-z._ -]*$",
    r"(?<=[A-Za-z]{4})v$",
    r"\bv$",
]

#: What a title without a digit ends with if one of these patterns fits.
SUFFIX_LOOK = r"(?i)(?:\)|version|bonus|extras?|demo|v)$"

#: What is taken from the end of a title to make its key, in this order.
KEY_TAILS = [
    r"\b(?:full\s*version|vollversion|bonus|extras?)\b$",
    r"\bdemo\b$",
    r"\bversion\s*[0-9][0-9a-z ]*$",
    r"\bupdate\s*[0-9][0-9a-z ]*$",
    r"\bv\s*[0-9][0-9a-z ]*$",
    r"\bv$",
]
#: What a title without a digit ends with if one of these patterns fits.
KEY_LOOK = r"(?:version|bonus|extras?|demo|v)$"
#: Versions at the end of a title that is looked up.
VERSION_TAILS = [
    r"(?i)\s+v(?:ersion)?\s*\d+(?:[\s._-]*\d+)*(?:[a-z])?$",
    r"(?i)\s+v\d+(?:[\s._-]*\d+)*(?:[a-z])?$",
]
#: Markup and what it becomes, in this order.
MARKUP = [
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)</?(div|p|li|ul|ol|h[1-6])[^>]*>", "\n"),
    (r"<[^>]+>", " "),
]
#: Fixed value: what stands between the items of a line.
ITEM_MARKS = r"\s*[•;]\s*|\s+\|\s+|\s+/\s+|\s+\*\s+|\s+-\s+"
