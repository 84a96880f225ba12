"""Fixed values of the linkage rules."""

# Legal forms, in order; the first that matches wins.
LEGAL_FORMS = [
    (r"\b(private\s+limited|pvt\s+ltd|pvt\.\s*ltd|pvt\s+limited|private\s+ltd)\b", "pvtltd"),
    (r"\b(public\s+limited|public\s+ltd)\b", "publicltd"),
    (r"(पर\s*इवट\s*ल\s*म\s*टड|पाइवट\s*लिमिटेड|प्राइवेट\s*लिमिटेड)", "pvtltd"),
    (r"(पबलक\s*ल\s*म\s*टड|पब्लिक\s*लिमिटेड)", "publicltd"),
    (r"(ल\s*म\s*टड|लिमिटेड)", "ltd"),
    (r"\b(limited\s+liability\s+company|l\.l\.c\.|llc)\b", "llc"),
    (r"\b(incorporated|inc\.|inc)\b", "inc"),
    (r"\b(corporation|corp\.|corp)\b", "corp"),
    (r"\b(limited\s+liability\s+partnership|l\.l\.p\.|llp)\b", "llp"),
    (r"\b(limited|ltd\.|ltd)\b", "ltd"),
    (r"\b(company|co\.|co)\b", "co"),
    (r"\b(s\.a\.s\.u\.|sasu)\b", "sasu"),
    (r"\b(s\.a\.s\.|sas)\b", "sas"),
    (r"\b(s\.a\.r\.l\.|sarl)\b", "sarl"),
    (r"\b(e\.u\.r\.l\.|eurl)\b", "eurl"),
    (r"\b(s\.a\.|sa)\b", "sa"),
    (r"\b(s\.c\.i\.|sci)\b", "sci"),
    (r"\b(s\.n\.c\.|snc)\b", "snc"),
    (r"\b(e\.i\.|ei)\b", "ei"),
    (r"\b(gmbh)\b", "gmbh"),
]

# Street abbreviations.
STREET = dict(
    x.split("=")
    for x in """st=street rd=road ave=avenue blvd=boulevard bd=boulevard ln=lane dr=drive ct=court hwy=highway apt=apartment ste=suite
bldg=building fl=floor pkwy=parkway pl=place sq=square ter=terrace no=number sec=sector blk=block rue=rue r=rue av=avenue ch=chemin
chemin=chemin imp=impasse impasse=impasse all=allee allee=allee crs=cours cour2=cours cours=cours rte=route route=route fbg=faubourg""".split()
)

# Devanagari to Latin.
DEVANAGARI = dict(
    x.split("=")
    for x in """क=k ख=kh ग=g घ=gh ङ=ng च=ch छ=chh ज=j झ=jh ञ=ny ट=t ठ=th ड=d ढ=dh ण=n त=t थ=th द=d ध=dh न=n प=p फ=ph ब=b भ=bh म=m
य=y र=r ल=l व=v श=sh ष=sh स=s ह=h अ=a आ=aa इ=i ई=ee उ=u ऊ=oo ऋ=ri ए=e ऐ=ai ओ=o औ=au ा=a ि=i ी=i ु=u ू=u े=e ै=ai ो=o ौ=au
ं=n ँ=n ः=h ्= ़= ०=0 १=1 २=2 ३=3 ४=4 ५=5 ६=6 ७=7 ८=8 ९=9""".split()
)

# Words that make no blocking key.
NAME_STOP = """the and inc corp corporation llc llp ltd limited pvt private co company sa sarl gmbh services solutions enterprises traders
group india hotel shree sri new dr mr mrs saint restaurant cafe bar store shop sas sasu eurl sci snc france association societe club
centre""".split()
ADDR_STOP = """near behind opp opposite shop no floor suite ste unit apt apartment bldg building road rd street st avenue ave lane ln
drive dr court ct boulevard blvd bd highway hwy phase block sector post po box pmb nagar colony marg puram pradesh state district dist
bengal maharashtra karnataka tamil nadu delhi mumbai calcutta kolkata chennai hyderabad bangalore bengaluru village taluk tehsil west
east north south rue chemin impasse cours allee place route faubourg de du la des le les""".split()

# Patterns and limits.
HANDLE = r"(@|https?://|www\.)"
DOMAIN = r"\.(com|org|net|in|co|io|fr|gov|edu|biz|info)\b"
NOT_WORD = r"[^\p{L}\p{N}_\s]"
NULL_WORDS = ["nan", "null", "none", "<null>"]
MAX_POSTINGS, TOP_K = 50, 12
FAMILIES = ["tok", "bi", "pref4", "addr_tok", "addr_pair", "zip_num", "sn_w", "zip_w", "st_zip", "st_sn", "bn_sn", "bn_zip", "skel"]
