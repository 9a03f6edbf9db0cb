"""A short list of words for problem 7."""

from __future__ import annotations

# Words that abuse or are sexually explicit in nearly every use, in four languages. A trailing * stands for any ending.
EXPLICIT = frozenset(
    """
arsehole* asshole* asshat* bastard* bellend* bitch* blowjob* bollocks bullshit* cock cocks cocksuck* cretin* cum cunt* dickhead* dipshit* douchebag* dumbass* fag faggot* fuck* goddamn* halfwit* handjob*
horny idiot* imbecile* jackass* jizz loser losers masturbat* moron* motherfuck* nudes numbskull* orgasm* penis pervert* piss* porn* prick pricks pussy retard* scum scumbag* shit* slut* subhuman* tits
tosser* twat* wank* whore* dick dicks
abschaum arsch* drecks* dummkopf* fick* fotze* hure* missgeburt* mistkerl* nutte* scheiss* schlampe* schwachkopf* titten trottel* ungeziefer verpiss* vollidiot* wichser*
cabron* cojones escoria follar* gilipollas imbecil* joder* maric* mierda* pendej* polla puta* puto* subnormal* tetas verga zorra*
abruti* batard* branleur* connard* connasse* couille* encul* foutre merde* nique* petasse* poufiasse* pouffiasse* putain* pute putes salaud* salope* suce trouduc*
""".split()
)
