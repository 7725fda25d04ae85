"""Places: country names and codes, and terms that make a name no more distinctive.

Parity with complete gazetteers is not a goal; more terms can be given wherever these are used.
"""

from __future__ import annotations

# ISO 3166 codes of country names in common use.
COUNTRY_CODES = {
    "argentina": "AR", "australia": "AU", "austria": "AT", "bangladesh": "BD", "belgium": "BE", "brazil": "BR", "canada": "CA", "chile": "CL", "china": "CN", "colombia": "CO",
    "czech republic": "CZ", "czechia": "CZ", "denmark": "DK", "egypt": "EG", "england": "GB", "ethiopia": "ET", "finland": "FI", "france": "FR", "germany": "DE", "greece": "GR",
    "hong kong": "HK", "hungary": "HU", "india": "IN", "indonesia": "ID", "iran": "IR", "iraq": "IQ", "ireland": "IE", "israel": "IL", "italy": "IT", "japan": "JP",
    "kenya": "KE", "korea, republic of": "KR", "lebanon": "LB", "malaysia": "MY", "mexico": "MX", "morocco": "MA", "nepal": "NP", "netherlands": "NL", "new zealand": "NZ", "nigeria": "NG",
    "norway": "NO", "pakistan": "PK", "peru": "PE", "philippines": "PH", "poland": "PL", "portugal": "PT", "romania": "RO", "russia": "RU", "russian federation": "RU", "saudi arabia": "SA",
    "singapore": "SG", "south africa": "ZA", "south korea": "KR", "spain": "ES", "sweden": "SE", "switzerland": "CH", "taiwan": "TW", "thailand": "TH", "turkey": "TR", "ukraine": "UA",
    "united arab emirates": "AE", "united kingdom": "GB", "united states": "US", "united states of america": "US", "usa": "US", "vietnam": "VN", "viet nam": "VN",
}

# Adjectives of places.
DEMONYMS = "korean chinese japanese american british english german french italian spanish indian african brazilian mexican canadian australian russian polish dutch swedish norwegian danish swiss finnish irish scottish welsh turkish greek egyptian nigerian kenyan ethiopian moroccan thai vietnamese indonesian malaysian filipino taiwanese singaporean pakistani bangladeshi nepali saudi iranian iraqi israeli palestinian lebanese european asian latin nordic scandinavian arabic hispanic caribbean pacific atlantic mediterranean philippine".split()
# Short names of countries.
SHORT_COUNTRIES = "korea japan china taiwan vietnam thailand indonesia malaysia singapore philippines india pakistan bangladesh nepal iran iraq israel palestine lebanon saudi egypt nigeria kenya ethiopia morocco brazil mexico canada usa britain england scotland wales ireland france germany italy spain netherlands belgium sweden norway denmark finland poland russia turkey greece australia zealand".split()
# Words that qualify places.
QUALIFIERS = "northern southern eastern western central north south east west greater metro regional provincial municipal county state national federal republic kingdom prefecture district territory province region area".split()
# Words that qualify organizations.
ORGANIZATION_WORDS = "association society institute institution organization foundation corporation company group consortium university college school academy center centre hospital clinic medical health healthcare department division office bureau agency laboratory research sciences studies program network system systems services service international global world worldwide general special advanced applied basic public private community professional".split()
# Large cities of one word, a documented subset of a gazetteer.
CITIES = "london paris berlin madrid rome vienna tokyo osaka kyoto seoul busan beijing shanghai guangzhou shenzhen wuhan nanjing delhi mumbai chennai kolkata bangalore hyderabad moscow toronto montreal vancouver boston chicago houston dallas philadelphia seattle denver atlanta miami sydney melbourne brisbane perth dublin lisbon porto amsterdam rotterdam brussels antwerp zurich geneva basel munich hamburg frankfurt cologne stockholm oslo copenhagen helsinki warsaw krakow prague budapest bucharest athens istanbul ankara cairo lagos nairobi johannesburg santiago lima bogota".split()


def stopwords(more: tuple[str, ...] = ()) -> list[str]:
    """All terms, sorted: only terms of one word can ever equal a token."""
    return sorted({*DEMONYMS, *SHORT_COUNTRIES, *QUALIFIERS, *ORGANIZATION_WORDS, *CITIES, *(k for k in COUNTRY_CODES if " " not in k and "," not in k), *more})
