"""Stop words as plain data, so that neither a jar nor a running JVM is needed to read them.

Fixed values: the lists that Apache Spark ships (Apache License 2.0), which come from the
Snowball project (BSD licence). One word after another, in their order.
"""

from __future__ import annotations

ENGLISH = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
"""

FRENCH = """
au aux avec ce ces dans de des du elle en et eux il je la le les leur lui ma mais me même mes moi mon ne nos
notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos votre vous c d j l
à m n s t y été étée étées étés étant étante étants étantes suis es est sommes êtes sont serai seras sera
serons serez seront serais serait serions seriez seraient étais était étions étiez étaient fus fut fûmes fûtes
furent sois soit soyons soyez soient fusse fusses fût fussions fussiez fussent ayant ayante ayantes ayants eu
eue eues eus ai as avons avez ont aurai auras aura aurons aurez auront aurais aurait aurions auriez auraient
avais avait avions aviez avaient eut eûmes eûtes eurent aie aies ait ayons ayez aient eusse eusses eût
eussions eussiez eussent
"""

RUSSIAN = """
и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по только ее мне было вот от меня
еще нет о из ему теперь когда даже ну вдруг ли если уже или ни быть был него до вас нибудь опять уж вам ведь
там потом себя ничего ей может они тут где есть надо ней для мы тебя их чем была сам чтоб без будто чего раз
тоже себе под будет ж тогда кто этот того потому этого какой совсем ним здесь этом один почти мой тем чтобы
нее сейчас были куда зачем всех никогда можно при наконец два об другой хоть после над больше тот через эти
нас про всего них какая много разве три эту моя впрочем хорошо свою этой перед иногда лучше чуть том нельзя
такой им более всегда конечно всю между
"""

_LISTS = {"english": ENGLISH, "french": FRENCH, "russian": RUSSIAN}


def words(language: str) -> list[str]:
    """The list of one language; an unknown language is an error that names the known ones."""
    if language not in _LISTS:
        raise ValueError(f"no stop words for {language!r}; known: {', '.join(_LISTS)}")
    return _LISTS[language].split()
