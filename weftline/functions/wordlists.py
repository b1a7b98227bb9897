"""Word lists and label sets that results depend on."""

# The common public English stop-word list used for search.  Its entries with an
# apostrophe are left out, because the search tokenizer never yields one.
SEARCH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
    hers herself it its itself they them their theirs themselves what which who whom this that these
    those am is are was were be been being have has had having do does did doing a an the and but if
    or because as until while of at by for with about against between into through during before after
    above below to from up down in out on off over under again further then once here there when where
    why how all any both each few more most other some such no nor not only own same so than too very s
    t can will just don should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma
    mightn mustn needn shan shouldn wasn weren won wouldn
    """.split()
)

# Stop words of the news classifier.
NEWS_STOP_WORDS = tuple(
    """
    the a an and or but in on at to for of with by from as is was are be this that it you he she we
    they what which who when where why how all each every can will just should would could been has
    have had do does did am one two
    """.split()
)

# Entity labels kept by the batch count and by the stream count.
BATCH_ENTITY_LABELS = ("PERSON", "GPE", "ORG", "LOC")
STREAM_ENTITY_LABELS = ("PERSON", "ORG", "GPE", "LOC", "PRODUCT", "WORK_OF_ART", "EVENT", "FAC")
