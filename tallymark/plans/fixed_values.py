"""What the reports look for in clinical notes, and their labels."""

from __future__ import annotations

from tallymark.functions import scopes
from tallymark.functions.scopes import BACKWARD, BOTH, NEGATED, OFFERED, OTHER, PAST, PLANNED, Cue, End, Lift, Mention

# The cheap first look for candidate notes, and the labels of a screening code.
CANDIDATE_KEYWORDS = "cessation|quitline|nicotine|counsel"
STATUS_LABELS = {"CURRENT": "current_user", "NON_USER": "non_user", "UNKNOWN": "unknown"}
STATUS_OTHERWISE = "not_done"
# The notes that show what does and does not count.
CONTRAST_NOTES = [
    "Discussed stopping tobacco and referred the patient to the quitline during this visit.",
    "Current tobacco use documented. Patient declined cessation counseling today.",
    "Prior tobacco counseling is mentioned in history; no new cessation treatment today.",
    "A family member received cessation counseling; no intervention was given to this patient.",
]

# --- Cessation care given to this patient at this visit: own rules, in lower case --------------
# Word lists of the rules below.
WHOSE = r"(?:(?:the|a|an|his|her|their|my|patient's|pt's) )*"
RELATION = (
    r"(?:family members?|family|spouse|husband|wife|partner|mother|father|mom|dad|sons?|daughters?|child|children|kids?"
    r"|brother|sister|friend|roommate|caregivers?|parents?|grandparents?|relatives?|coworkers?|household members?)"
)
DRUGS = (
    r"(?:varenicline|chantix|bupropion|zyban|wellbutrin|nicotine (?:replacement|patch\w*|gum|lozenges?|inhalers?|nasal spray|spray)"
    r"|nrt|(?:transdermal|combination) nicotine|cessation (?:medications?|pharmacotherapy|aids?|drugs?)|pharmacotherapy for (?:smoking|tobacco))"
)
ACTS = (
    r"\b(?:given|gave|giving|provid(?:ed|ing)|dispens(?:ed|ing)|prescri(?:bed|bing|ption)|start(?:ed|ing)|initiat(?:ed|ing)|order(?:ed|ing)"
    r"|rx|sent|refilled|supplied|issued|recommend(?:ed|ing)|suggested|continu(?:ed|ing)|renewed|begun|began|handed|e-?prescribed"
    r"|administered|offer(?:ed|ing)|placed on|put on|called in)\b"
)
STOPPING = r"(?:quit(?:ting)?|stop(?:ping)?|cessation|cut(?:ting)? (?:down|back)|giv(?:e|ing) up|reduc(?:e|ing)|abstinence|abstain(?:ing)?)"
USE = r"(?:tobacco|smok\w*|cigar\w*|nicotine|vap(?:e|es|ed|ing)|e-?cig\w*|chew(?:ing)? tobacco|snuff|dip)"
TIME = r"(?:visit|appointment|appt|encounter|session|follow-?up|week|month|year|time)"
# Care that is told of by one word or a few.
CARE = (
    r"\b(?:counsel(?:l?ed|l?ing|s)?|advis(?:ed|ing|es)|(?:brief|cessation|quit|strong|firm) advice|advice (?:to|on|about)|coach(?:ed|ing)"
    r"|educat(?:ed|ion|ing)|taught|handouts?|brochures?|pamphlets?|leaflets?|booklets?|educational materials?|written (?:information|materials?)|resources"
    r"|motivational interview(?:ing)?|encourag(?:ed|ement|ing)|urged|referr(?:ed|al|als|ing)|enroll?(?:ed|ment|ing)|quit ?line|quit plan"
    r"|connected (?:\w+ ){0,3}(?:to|with)|set (?:a |up a )?quit date|quit date (?:was )?set|intervention|interventions|cessation treatment"
    r"|(?:instruct|told|remind|recommend)(?:ed|ing)? (?:that )?(?:the |him |her |them )?(?:patient |pt |he |she |they )?(?:should |to )?" + STOPPING +
    r"|(?:discuss|review|explain|address|cover|went over|emphasi[sz]|stress|reinforc|talk|spoke|speak|spent)(?:ed|ing)?(?: \w+){0,6}? "
    r"(?:importance|benefits?|risks?|harms?|dangers?|need|options?|ways|strateg(?:y|ies)|methods?|techniques?|plan|readiness|treatments?|medications?|triggers|" + STOPPING + r"))\b"
)
NOTE_RULES = scopes.ScopeRules(
    mentions=(
        Mention("care", CARE),
        Mention("drug", r"\b" + DRUGS + r"\b", needs=ACTS),
    ),
    neutral=(
        r"\b(?:with|and|while) " + WHOSE + RELATION + r" (?:was |were |is |are )?(?:present|at (?:the )?bedside|in (?:the )?room|attending|accompanying)\b",
        r"\b" + RELATION + r" (?:was |is )?(?:present|at (?:the )?bedside|in (?:the )?room)\b",
        r"\b(?:will |to |plan to )?(?:follow[ -]?up|f/u|return|rtc|recheck|see (?:him|her|them|patient|pt)|revisit|reassess)(?: visit| appointment| call)?"
        r"(?: \w+){0,3}? (?:in|next|at|on|within|after)(?: (?:a|an|the|next|\d+|one|two|three|four|six))* (?:visits?|appointments?|days?|weeks?|months?|years?)\b",
        r"\b(?:no|not|without) (?:further |other )?(?:barriers?|concerns?|questions?|problems?|issues?|side effects?|adverse effects?|contraindications?|difficult\w+|distress)\b",
        r"\bnot only\b",
        r"\boffered and (?:accepted|provided|given|received)\b",
        r"\b(?:family|smoking|social|medical|past medical) history(?: of (?:" + USE + r")(?: use)?)?(?= (?:reviewed|updated|obtained|taken))",
    ),
    cues=(
        # Not done; what follows a list word stays in the scope, see the ends.
        Cue(
            r"\b(?:(?:was|were|is|are|has been|have been|had been|be|could|would|did|does|do)(?: not|n't)(?: able to)?(?: be)? "
            r"(?:done|given|provided|performed|completed|offered|addressed|discussed|delivered|indicated|needed|documented|possible|attempted|received|required|appropriate|conducted|held))\b",
            NEGATED, BOTH,
        ),
        Cue(
            r"\b(?:declin(?:ed|es|ing)|refus(?:ed|es|ing)|deferr?(?:ed|s|ing)|postponed|cancel(?:l?ed)|skipped|omitted|held)"
            r"(?= *(?:$|[,:)]|it|this|that|these|those|both|all|any|help|services?|the offer|today|at this|for now|for today|by|until|due|again|and|as|because))",
            NEGATED, BOTH,
        ),
        Cue(r"\b(?:not|n't|never) (?:been )?(?:interested|ready|willing|receptive|amenable|motivated|wanting)\b|\b(?:uninterested|unwilling)\b", NEGATED, BOTH),
        Cue(r"\b(?:declin(?:ed|es|ing)|refus(?:ed|es|ing|al)|deferr?(?:ed|s|ing|al)|den(?:ied|ies|ying)|unable to|failed to|forgot to|instead of|rather than|lack of|ran out of time)\b", NEGATED),
        Cue(r"\b(?:no|not|never|without|nor|neither|cannot|(?:did|does|do|was|were|is|are|has|have|had|could|would|can|wo|should)n'?t|non)\b", NEGATED),
        Cue(r"\ballerg(?:ic|y|ies)\b|\bintoleran(?:t|ce)\b|\bcontraindicated\b|\badverse reaction\b", NEGATED, BOTH),
        Cue(
            r"\b(?:stopped|discontinued|d/c'?d|self-discontinued|ran out of|finished|weaned off|came off|off)(?= (?:(?:the|his|her|their|taking|using|on|of|all) )*" + DRUGS + r")",
            NEGATED,
        ),
        # At another time.
        Cue(r"\b(?:\w+ )?(?:years?|months?|weeks?|days?) ago\b|\b(?:in|during) the past\b|\b(?:last|prior|previous|earlier) " + TIME + r"\b|\bat an? (?:earlier|outside|previous|prior)\b|\bin history\b|\bin (?:19|20)\d\d\b|\bas a (?:teen\w*|child)\b", PAST, BOTH),
        Cue(r"\b(?:history of|h/o|prior|previous(?:ly)?|formerly|used to|in the past|earlier|remote)\b", PAST),
        # Still to come.
        Cue(r"\bto be (?:given|done|provided|placed|made|completed|scheduled|discussed|offered|started|arranged|sent|ordered|addressed)\b", PLANNED, BOTH),
        Cue(
            r"\b(?:at|on|during|for|until|by) (?:a |an |the |his |her |their )?(?:next|future|upcoming|later|follow-?up|subsequent|following) ?(?:" + TIME + r")?\b|\bnext (?:" + TIME + r")\b|\bin the future\b|\btomorrow\b"
            r"|\b(?:is |was |are |were |to be )?(?:planned|scheduled|pending|anticipated|due)\b(?! to)", PLANNED, BOTH,
        ),
        Cue(
            r"\b(?:will|plans? (?:to|is to|for)|planning (?:to|on)|to be|going to|would like(?: to)?|would benefit|could benefit|may benefit|might|consider(?:s|ed|ing)?|scheduled (?:for|to)|intends? to"
            r"|needs?(?: to be)?|should be|wants? to|hopes? to|thinking about|if (?:he|she|they|patient|pt|interested|needed|desired|willing|agreeable)|due (?:for|to)(?= (?:be |receive |start |get )))\b", PLANNED,
        ),
        Cue(r"\b(?:offer(?:ed|s|ing)?|made available|available)\b", OFFERED, BOTH),
        # About someone else: the last one named before the care, or whom the care went to.
        Cue(r"\b(?:counsel(?:l?ed|l?ing)|advis(?:ed|ing)|educat(?:ed|ing)|coached|encouraged|urged|referred|enrolled|taught|told|gave)(?= (?:to |with )?" + WHOSE + RELATION + r"\b(?! and (?:the )?(?:patient|pt)\b))", OTHER, BOTH),
        Cue(r"\b(?:to|for|with) " + WHOSE + RELATION + r"\b", OTHER, BOTH),
        Cue(r"\b(?<!(?:patient|pt) and )(?<!(?:patient|pt) and his )(?<!(?:patient|pt) and her )" + RELATION + r"\b(?! history)", OTHER),
    ),
    ends=(
        End(r",(?![^.;,]* (?:or|nor)\b)", NEGATED | PAST | PLANNED | OFFERED),
        End(r"\b(?:patient|pt)\b(?!'s)", OTHER),
    ),
    lifts=(
        Lift(r"\b(?:today|(?:this|today's) (?:visit|encounter|appointment)|during (?:the|our) (?:visit|encounter)|now|currently)\b", PAST | PLANNED),
        Lift(r"\b(?:accept(?:ed|s|ing)|agree(?:d|s|able)|took|received|signed up)\b", OFFERED, before=True),
    ),
    topic=r"\b(?:tobacco|smok|cigar|nicotine|vap(?:e|ing)|e-?cig|quit|cessation|chew|snuff|" + DRUGS.replace("bupropion|", "").replace("wellbutrin|", "") + r")",
    other_topic=(
        r"\b(?:diet|exercise|weight|alcohol|drinking|sleep|vaccin|immuni[sz]|diabet|blood pressure|hypertension|medication|flu\b|falls?\b|nutrition|cardiology|physical therapy"
        r"|podiatry|depress|anxiety|pain|cholesterol|asthma|allerg|contracepti|seat ?belt|skin|dental|foot care|mammogram|colonoscopy|screening)"
    ),
    refusal=(
        r"^\W*(?:(?:the )?(?:patient|pt|he|she|they|and|but|this|it|that|was|were) )*(?:politely |again |then |has |had )*"
        r"(?:declin(?:ed|es)|refus(?:ed|es)|not interested|deferr?ed|not done|not given|not provided|not ready)"
        r"(?:,? (?:it|this|that|both|all|any|help|services|the offer|today|again|at this time|for now|by (?:the )?(?:patient|pt)|(?:due to|because)\b.*))*\W*$"
    ),
    boundary=r"(?<!\d)[.]|[.](?!\d)|[;!?\n]+|,? \bbut\b|,? \bhowever\b,?|,? \b(?:al)?though\b|,? and (?=(?:has |then |politely )?(?:declined|refused|deferred))",
)
