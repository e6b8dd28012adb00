"""Small texts in the six languages: what a language model starts from before any row of the input is seen."""

# Written for this module: everyday sentences, so that every language has some text even where a table has none.
SEEDS = {
    "hi": (
        "यह किताब मेरे भाई की है और वह इसे रोज़ पढ़ता है।",
        "क्या आप मुझे बता सकते हैं कि बाज़ार कहाँ है?",
        "हम लोग कल शाम को गाँव गए थे लेकिन बारिश के कारण जल्दी लौट आए।",
        "बच्चों को समय पर खाना और नींद चाहिए होती है।",
        "उसने कहा कि काम पूरा हो गया है, इसलिए अब घर जाना चाहिए।",
    ),
    "mr": (
        "हे पुस्तक माझ्या भावाचे आहे आणि तो ते रोज वाचतो.",
        "बाजार कुठे आहे ते तुम्ही मला सांगू शकता का?",
        "आम्ही काल संध्याकाळी गावाला गेलो होतो पण पावसामुळे लवकर परत आलो.",
        "मुलांना वेळेवर जेवण आणि झोप हवी असते.",
        "तो म्हणाला की काम पूर्ण झाले आहे, म्हणून आता घरी जायला पाहिजे.",
    ),
    "hinglish": (
        "yeh kitaab mere bhai ki hai aur woh ise roz padhta hai.",
        "kya aap mujhe bata sakte hain ki bazaar kahan hai?",
        "hum log kal shaam ko gaon gaye the lekin barish ke kaaran jaldi laut aaye.",
        "bachchon ko time par khana aur neend chahiye hoti hai.",
        "usne kaha ki kaam poora ho gaya hai isliye ab ghar jaana chahiye.",
    ),
    "en": (
        "This book belongs to my brother and he reads it every day.",
        "Could you tell me where the market is?",
        "We went to the village yesterday evening but came back early because of the rain.",
        "Children need food and sleep at the right time.",
        "He said that the work was finished, so it is time to go home.",
    ),
    "bn": (
        "এই বইটি আমার ভাইয়ের এবং সে রোজ এটি পড়ে।",
        "বাজার কোথায় তা কি আমাকে বলতে পারেন?",
        "আমরা গতকাল সন্ধ্যায় গ্রামে গিয়েছিলাম কিন্তু বৃষ্টির জন্য তাড়াতাড়ি ফিরে এসেছি।",
    ),
    "ta": (
        "இந்த புத்தகம் என் தம்பியுடையது, அவன் தினமும் படிக்கிறான்.",
        "சந்தை எங்கே இருக்கிறது என்று சொல்ல முடியுமா?",
        "நாங்கள் நேற்று மாலை ஊருக்குச் சென்றோம், ஆனால் மழையால் சீக்கிரம் திரும்பினோம்.",
    ),
}
