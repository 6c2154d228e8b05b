"""Clinical notes labelled by hand: whether cessation care was given to this patient at this visit."""

from tallymark.plans.fixed_values import CONTRAST_NOTES

NOTES = [
    # (note, qualifies)
    ("Cessation counseling offered. Patient declined.", False),
    ("Husband was counseled on quitting smoking.", False),
    ("Will be counseled on tobacco next month.", False),
    ("Counseled on diet and exercise today.", False),
    ("Prescribed varenicline for smoking cessation today.", True),
    ("Started bupropion to help stop smoking.", True),
    ("Nicotine patch given today.", True),
    ("Gave quitline number to patient.", True),
    ("Counseled patient on tobacco with no barriers noted.", True),
    ("Counseled on cessation; also referred to quitline.", True),
    ("", False),
    (None, False),
    ("Patient counseled on smoking cessation with wife present.", True),
    ("Wife present and patient counseled on smoking cessation.", True),
    ("Referred his wife to the quitline.", False),
    ("Counseled the patient's daughter about vaping.", False),
    ("Patient's mother was referred to a cessation program.", False),
    ("Declined nicotine patch but counseled on quitting.", True),
    ("Counseled on quitting smoking but declined nicotine patch.", True),
    ("Counseled on smoking cessation. Patient declined flu shot.", True),
    ("Offered quitline referral. Refused.", False),
    ("Quitline referral offered and accepted.", True),
    ("Cessation counseling offered.", False),
    ("Smoker, counseled today and will follow up next month.", True),
    ("Will start varenicline next visit.", False),
    ("Cessation counseling scheduled for next week.", False),
    ("Considering nicotine gum.", False),
    ("History of smoking; received counseling in the past.", False),
    ("Previously counseled on tobacco cessation.", False),
    ("Former smoker, previously on Chantix, counseled on relapse prevention today.", True),
    ("Tobacco use discussed. Counseling provided.", True),
    ("Tobacco use noted. Counseled on diet.", False),
    ("Smokes one pack daily. Medication counseling provided.", False),
    ("Not counseled on smoking today.", False),
    ("Did not discuss cessation; patient was not referred to the quitline.", False),
    ("Patient denies receiving smoking counseling.", False),
    ("Enrolled in the cessation program.", True),
    ("NRT lozenges dispensed.", True),
    ("Nicotine lozenge dispensed and use explained.", True),
    ("Referred to cardiology for chest pain.", False),
    ("Smoker. Referred to physical therapy.", False),
    ("Advised to quit smoking; set a quit date.", True),
    ("Cessation referral pending.", False),
    ("Spouse smokes. Patient does not use tobacco.", False),
    ("Connected patient with quitline coach today.", True),
    ("Two years ago was prescribed bupropion for smoking.", False),
    ("Counselled on smoking cessation, tolerated well.", True),
    ("Smoking cessation counseling to be given at the follow-up visit.", False),
    *zip(CONTRAST_NOTES, (True, False, False, False)),
    ("Smokes daily. Went over brief advice and a quit plan with her today.", True),
    ("Coached on cutting down cigarettes; phone support arranged.", True),
    ("Urged to stop vaping and agreed to call the quitline.", True),
    ("Vital signs stable, chart reviewed.", False),
    ("Chews tobacco; last quit attempt 2019. Labs reviewed.", False),
    ("Smoker. No intervention was possible because of the fire drill.", False),
    # Named by a reviewer as misread before.
    ("Discussed importance of quitting smoking with patient for 10 minutes.", True),
    ("Tobacco cessation education provided at this visit.", True),
    ("Encouraged patient to stop smoking and provided resources.", True),
    ("Smoking cessation handout given.", True),
    ("Motivational interviewing for tobacco use performed.", True),
    ("Tobacco counseling was not done today due to time.", False),
    ("Patient takes bupropion for depression. Former smoker.", False),
    ("Allergic to nicotine patch.", False),
    ("Stopped varenicline because of nausea.", False),
]

# Written after the rules, which read 45 of the 49 rightly at first; the rest led to changes.
UNSEEN = [
    ("Spent 5 minutes talking about ways to quit vaping.", True),
    ("Nicotine gum 4 mg prescribed, use explained.", True),
    ("Pamphlet on smoking cessation handed to the patient.", True),
    ("Pt advised to cut down on cigarettes.", True),
    ("Reviewed benefits of quitting tobacco; pt agrees to set a quit date.", True),
    ("Told patient to quit smoking.", True),
    ("Tobacco abuse: counselling done.", True),
    ("Smoking - advised cessation, offered NRT, patient accepted.", True),
    ("Started on Chantix today for tobacco dependence.", True),
    ("Patient and his wife were counseled on smoking cessation.", True),
    ("Offered nicotine lozenges. Patient agreed.", True),
    ("Strong advice to stop smoking was delivered.", True),
    ("Despite wife smoking at home, patient was encouraged to quit.", True),
    ("She was given written materials about smoking cessation.", True),
    ("Patient not ready to quit, but counseled on risks of smoking.", True),
    ("Enrolled in tobacco treatment program this visit.", True),
    ("Counseled regarding tobacco cessation. No questions.", True),
    ("Smokes 1.5 ppd, counseled on quitting.", True),
    ("Refilled nicotine patches and discussed triggers.", True),
    ("Educated on the harms of vaping.", True),
    ("Tobacco use was addressed: quitline number given.", True),
    ("Smoker. Brief intervention delivered by nurse.", True),
    ("Emphasized importance of smoking cessation.", True),
    ("Counseling not provided, patient left early. Smoker.", False),
    ("Smoking cessation was discussed at a previous visit.", False),
    ("No time for tobacco counseling.", False),
    ("Daughter was given a handout about vaping.", False),
    ("Patient refuses nicotine patch.", False),
    ("Would like to start varenicline at next visit.", False),
    ("Mother counseled on second hand smoke.", False),
    ("Counseled on weight loss. Smoker.", False),
    ("Tobacco: never. Counseled on seat belt use.", False),
    ("Wellbutrin continued for depression; smokes half a pack.", False),
    ("Cessation counseling deferred.", False),
    ("Nicotine patch caused rash, discontinued.", False),
    ("Patient never received counseling on smoking.", False),
    ("Referral to quitline to be placed next week.", False),
    ("Was counseled on tobacco last month.", False),
    ("Former smoker, quit 2015.", False),
    ("Neither advice nor handout on smoking was given.", False),
    ("Consider bupropion for smoking at follow-up.", False),
    ("If interested, counseling on quitting is available.", False),
    ("Quitline information offered but patient refused.", False),
    ("Smoking education could not be completed.", False),
    ("His brother was referred to the quitline.", False),
    ("Unable to counsel on tobacco as patient was sedated.", False),
    ("Patient has intolerance to varenicline.", False),
    ("Smokes. Diabetes education provided.", False),
    ("Instead of counseling on smoking, visit focused on fall.", False),
]

# Written after those changes; 
FRESH = [
    ("Smoking cessation: discussed NRT options and sent patch to pharmacy.", True),
    ("Patient counseled for 3 min on tobacco use.", True),
    ("Gave patient a brochure about quitting.", True),
    ("Tobacco user, quit plan reviewed and nicotine gum ordered.", True),
    ("Vaping cessation advice to patient, who was receptive.", True),
    ("Patient's smoking was addressed with motivational interviewing.", True),
    ("Provider urged patient to give up cigarettes.", True),
    ("Taught coping skills for cigarette cravings.", True),
    ("Referral placed to tobacco treatment specialist.", True),
    ("Smoker; not interested in quitting, advised of risks anyway.", True),
    ("Chantix renewed, tolerating well.", True),
    ("Discussed the dangers of e-cigarettes with him.", True),
    ("Tobacco cessation counseling: patient refused.", False),
    ("Did not want to talk about smoking.", False),
    ("Patient has tried nicotine gum before.", False),
    ("Her husband quit smoking with counseling.", False),
    ("Plan: tobacco education at next appointment.", False),
    ("Counseling on smoking was postponed.", False),
    ("No nicotine replacement prescribed.", False),
    ("Six months ago received cessation counseling.", False),
    ("Alcohol counseling provided.", False),
    ("Lives with smoker, partner advised to quit.", False),
    ("Should be counseled on tobacco.", False),
    ("Patient states that smoking handouts were not helpful in the past.", False),
]
