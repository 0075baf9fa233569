"""The data contract, the category table and the text lists.

Nothing in here is logic. The values have to be exactly these for results to
be right, so they are written out as plain text in their natural order.
"""

# --- fixed values: ticket schema -------------------------------------------

REQUIRED_KEYS = [
    "ticket_id",
    "created_at",
    "updated_at",
    "channel",
    "model",
    "dialect",
    "title_ar",
    "description_ar",
    "category_level_1",
    "category_level_2",
    "category_level_3",
    "category_path",
    "tags",
    "labels_json",
    "impact",
    "urgency",
    "priority",
    "sentiment",
]

LABEL_KEYS = ["l1", "l2", "l3", "tags"]
SCALE_KEYS = ["impact", "urgency", "priority"]

CHANNELS = ["email", "portal", "chatbot", "phone"]
SENTIMENTS = ["positive", "neutral", "negative", "mixed"]

# --- fixed values: category table (level 1, level 2, level 3 names, tags) ---

TAXONOMY = [
    ("Access", "Account",
     ["Password Reset", "Account Locked", "Profile Update"],
     ["password", "locked", "reset", "username", "2fa", "mfa", "sso"]),
    ("Access", "Permissions",
     ["Role Request", "Permission Denied", "Admin Access"],
     ["rbac", "permission", "access", "role", "admin", "denied"]),
    ("Access", "MFA/SSO",
     ["MFA Failure", "SSO Login Issue", "Authenticator Issue"],
     ["mfa", "2fa", "sso", "authenticator", "otp", "login"]),
    ("Network", "WiFi",
     ["Connectivity", "Authentication", "Slow Speed"],
     ["wifi", "ssid", "signal", "slow", "disconnect", "router"]),
    ("Network", "VPN",
     ["Connection Failure", "Credentials", "Split Tunnel"],
     ["vpn", "tunnel", "remote", "timeout", "certificate"]),
    ("Network", "Internet/LAN",
     ["No Internet", "DNS", "Latency"],
     ["dns", "latency", "packet", "gateway", "ip", "dhcp"]),
    ("Hardware", "Laptop/Desktop",
     ["Boot Issue", "Performance", "Battery"],
     ["battery", "boot", "slow", "overheat", "fan", "disk"]),
    ("Hardware", "Printer/Scanner",
     ["Print Failure", "Driver", "Paper Jam"],
     ["printer", "driver", "paper", "toner", "scan", "queue"]),
    ("Hardware", "Peripherals",
     ["Keyboard/Mouse", "Monitor", "Docking Station"],
     ["monitor", "hdmi", "usb", "keyboard", "mouse", "dock"]),
    ("Software", "Email/Calendar",
     ["Outlook Issue", "Mailbox Access", "Sync Problem"],
     ["outlook", "email", "mailbox", "sync", "calendar"]),
    ("Software", "Office Apps",
     ["Word/Excel", "License", "Crash"],
     ["excel", "word", "powerpoint", "license", "crash"]),
    ("Software", "Business App",
     ["Bug", "Feature Request", "Integration"],
     ["bug", "feature", "api", "integration", "error", "request"]),
    ("Security", "Malware/Phishing",
     ["Phishing Email", "Suspicious Link", "Virus Alert"],
     ["phishing", "malware", "virus", "spam", "suspicious"]),
    ("Security", "Policy/Compliance",
     ["Blocked Site", "Device Encryption", "Data Access"],
     ["policy", "blocked", "compliance", "encryption", "dlp"]),
    ("Service", "Request",
     ["New Device", "New Account", "Software Install"],
     ["request", "install", "setup", "new", "provision"]),
    ("Service", "Incident",
     ["Outage", "Degradation", "Intermittent"],
     ["outage", "down", "degraded", "incident", "intermittent"]),
]

# --- fixed values: leaf names that are renamed, (old triple, new triple) ----

LEAF_REMAP = [
    (("Software", "Office Apps", "Excel Crash"), ("Software", "Office Apps", "Crash")),
    (("Software", "Office Apps", "Performance"), ("Software", "Office Apps", "Word/Excel")),
]

# --- fixed values: lists the enrichment sentences draw from -----------------

OPERATING_SYSTEMS = ["Windows 10", "Windows 11", "macOS 14", "Ubuntu 22.04"]
OFFICE_VERSIONS = ["Office 365 v2401", "Office 365 v2402", "Office 2019", "Office LTSC 2021"]
WIFI_SSIDS = ["Company-Secure", "Company-Guest", "HQ-Floor3", "Warehouse-AP"]
WIFI_SIGNALS = ["ضعيفة", "متوسطة", "كويسة"]
VPN_ERRORS = ["Error 809", "Timeout", "IKE Auth failed", "Certificate expired"]
OUTLOOK_ERRORS = ["0x8004010F", "0x800CCC0E", "OST corruption", "Add-in conflict"]

TONE_SENTENCES = [
    "محتاج الموضوع يتحل بسرعة لو سمحتوا.",
    "جربت ريستارت وكمان عملت Repair بس نفس المشكلة.",
    "المشكلة بتظهر وتختفي، ومش ثابتة على طول.",
    "لو محتاجين لوجز أو سكرينشوت أنا جاهز أبعتها.",
]

REPEAT_SENTENCES = [
    "المشكلة بتحصل مع أكتر من زميل في نفس الفريق.",
    "جربت من شبكة مختلفة وبرضه نفس النتيجة.",
    "الموضوع مؤثر على الديدلاين بتاعي النهارده.",
    "سحبت Log من الحدث ومستعد أرفعه لكم لو محتاجين.",
]

# --- fixed values: sentence patterns (%s and %d are filled in) --------------

REPEAT_STAMP = "ملاحظة: ظهرت المشكلة حوالي الساعة %s:%s في مبنى A - الدور %d على %s."
VPN_SENTENCE = "بتحصل وانا على %s من البيت، وبيظهر %s."
OUTLOOK_VERSION_SENTENCE = "Outlook على %s ونسخة %s."
OUTLOOK_PROFILE_SENTENCE = "جربت امسح الـ OST واعمل Profile جديد."
OUTLOOK_CODE_SENTENCE = "أحياناً بيظهر كود %s."
WIFI_SENTENCE = "على شبكة %s في مبنى A الدور %d، الإشارة %s."
PERFORMANCE_SENTENCE = "الجهاز عليه %s وBusy وقت التشغيل. حصلت المشكلة بعد آخر تحديث."
OFFICE_SENTENCE = "نسخة الأوفيس: %s. الملفات على Share داخلي."
AGE_SENTENCE = "بقالها %d ساعة تقريبا."

# --- fixed values: synthesis texts -----------------------------------------

FALLBACK_TAGS = [
    "bug", "error", "request", "network", "wifi", "vpn", "outlook", "dns",
    "mfa", "sso", "printer", "laptop", "policy", "security",
]

# level 1, level 2, level 3, titles
TITLES = [
    ("Access", "Account", "Password Reset", ["نسيت الباسورد", "تغيير كلمة السر", "عاوز أعمل Reset للباسورد"]),
    ("Access", "Account", "Account Locked", ["الأكونت اتقفل", "حساب مغلق", "Account Locked"]),
    ("Access", "Account", "Profile Update", ["تحديث البروفايل", "تعديل بياناتي", "تغيير رقم الموبايل"]),
    ("Access", "Permissions", "Role Request", ["طلب صلاحيات", "عاوز Role جديد", "ترقية صلاحياتي"]),
    ("Access", "Permissions", "Permission Denied", ["معنديش صلاحية", "Permission Denied", "رفض الدخول"]),
    ("Access", "Permissions", "Admin Access", ["صلاحيات أدمن", "عايز Admin Access", "رفع الصلاحيات"]),
    ("Access", "MFA/SSO", "MFA Failure", ["MFA مش شغال", "مش بيوصل OTP", "الموثّق واقع"]),
    ("Access", "MFA/SSO", "SSO Login Issue", ["مشكلة SSO", "مش عارف أعمل Login", "الدخول الموحد مش شغال"]),
    ("Access", "MFA/SSO", "Authenticator Issue", ["مشكلة في الـ Authenticator", "الموثّق بيهنج", "الموبايل مش بيطلع كود"]),
    ("Network", "WiFi", "Connectivity", ["الواي فاي فاصل", "مش عارف ألقط WiFi", "مشكلة في النت"]),
    ("Network", "WiFi", "Authentication", ["مشكلة دخول WiFi", "كلمة سر الواي فاي", "مش بيقبل الـ SSID"]),
    ("Network", "WiFi", "Slow Speed", ["النت بطيء", "Slow WiFi", "سرعة ضعيفة"]),
    ("Network", "VPN", "Connection Failure", ["الـ VPN مش شغال", "VPN Timeout", "مشكلة في Remote Access"]),
    ("Network", "VPN", "Credentials", ["بيانات VPN غلط", "مش راضي يقبل اليوزر", "Credential Error"]),
    ("Network", "VPN", "Split Tunnel", ["مشكلة Split Tunnel", "بعض المواقع بتقف مع VPN", "Traffic رايح كله على الـ Tunnel"]),
    ("Network", "Internet/LAN", "No Internet", ["مفيش إنترنت", "النت قاطع", "الدنيا واقفة"]),
    ("Network", "Internet/LAN", "DNS", ["ترجمة الأسماء", "DNS مش شغال", "المواقع تفتح بـ IP بس"]),
    ("Network", "Internet/LAN", "Latency", ["Latency عالي", "البنج عالي", "تقطيع في الشبكة"]),
    ("Hardware", "Laptop/Desktop", "Boot Issue", ["الجهاز مش بيفتح", "مشكلة إقلاع", "OS مش داخل"]),
    ("Hardware", "Laptop/Desktop", "Performance", ["الجهاز تقيل", "تهنيج في الجهاز", "الأداء بطيء"]),
    ("Hardware", "Laptop/Desktop", "Battery", ["البطارية بتخلص بسرعة", "شاحن اللابتوب", "الجهاز بيسخن"]),
    ("Hardware", "Printer/Scanner", "Print Failure", ["البرنتر مش بتطبع", "الطباعة واقفة", "الطابعة معلقة"]),
    ("Hardware", "Printer/Scanner", "Driver", ["تعريف البرنتر", "Driver مشكلة", "الاسكانر مش ظاهر"]),
    ("Hardware", "Printer/Scanner", "Paper Jam", ["ورق معلق", "Paper Jam", "الطابعة عاملة صوت"]),
    ("Hardware", "Peripherals", "Keyboard/Mouse", ["الكيبورد/الماوس مش شغال", "زرار بايظ", "الماوس بيفصل"]),
    ("Hardware", "Peripherals", "Monitor", ["مشكلة في الشاشة", "HDMI مش قارئ", "السكرين بتفصل"]),
    ("Hardware", "Peripherals", "Docking Station", ["الدّوك مش قارئ", "USB-C Dock", "المنافذ مش شغالة"]),
    ("Software", "Email/Calendar", "Outlook Issue", ["الأوتلوك بيهنج", "Outlook Not Responding", "مش بيوصل إيميلات"]),
    ("Software", "Email/Calendar", "Mailbox Access", ["مش قادر أفتح الميلبوكس", "Access للميلبوكس", "Shared Mailbox"]),
    ("Software", "Email/Calendar", "Sync Problem", ["مشكلة سينك", "الإيميل مش بيتزامن", "Calendar مش بتتحدث"]),
    ("Software", "Office Apps", "Word/Excel", ["مشكلة Word/Excel", "الإكسيل بيقفل", "الورد مش بيفتح"]),
    ("Software", "Office Apps", "License", ["طلب تفعيل الأوفيس", "License Error", "الأوفيس محتاج تفعيل"]),
    ("Software", "Office Apps", "Crash", ["البرنامج بيقع", "App Crash", "السوفتوير بيقفل"]),
    ("Software", "Business App", "Bug", ["Bug في الأبلكيشن", "غلط في السيستم", "الأبلكيشن مش بيسيف"]),
    ("Software", "Business App", "Feature Request", ["طلب ميزة جديدة", "Feature Request", "نحتاج إضافة جديدة"]),
    ("Software", "Business App", "Integration", ["تكامل API", "Integration Issue", "الـ Webhook مش شغال"]),
    ("Security", "Malware/Phishing", "Phishing Email", ["إيميل مشكوك فيه", "بلاغ عن سبام", "Phishing"]),
    ("Security", "Malware/Phishing", "Suspicious Link", ["لينك مريب", "رابط مش آمن", "تحذير أمن"]),
    ("Security", "Malware/Phishing", "Virus Alert", ["تنبيه فيروس", "Virus Alert", "مالوير"]),
    ("Security", "Policy/Compliance", "Blocked Site", ["موقع محجوب", "Blocked Site", "السياسة مانعة الموقع"]),
    ("Security", "Policy/Compliance", "Device Encryption", ["تشفير الجهاز", "Encryption", "طلب BitLocker"]),
    ("Security", "Policy/Compliance", "Data Access", ["وصول للبيانات", "Data Access", "DLP"]),
    ("Service", "Request", "New Device", ["طلب لابتوب جديد", "طلب شاشة إضافية", "طلب ماوس/كيبورد"]),
    ("Service", "Request", "New Account", ["أكونت جديد", "حساب موظف جديد", "تهيئة مستخدم"]),
    ("Service", "Request", "Software Install", ["تنزيل برنامج", "Software Install", "طلب Setup"]),
    ("Service", "Incident", "Outage", ["السيستم واقع", "توقف الخدمة", "عطل عام"]),
    ("Service", "Incident", "Degradation", ["الخدمة بطيئة", "Degraded", "الأداء متذبذب"]),
    ("Service", "Incident", "Intermittent", ["الخدمة بتقطع", "انقطاع متكرر", "Intermittent Issue"]),
]

# level 1, level 2, level 3, descriptions
DESCRIPTIONS = [
    ("Network", "VPN", "Connection Failure", [
        "كل ما أحاول أربط بالـ VPN بيطلعلي Timeout أو Error 809. جربت كذا مرة من البيت ومن الداتا لسه نفس المشكلة.",
        "الـ VPN بيقطع بعد 2-3 دقايق. محتاج أشتغل ريموت ومش عارف أكمل شغلي.",
    ]),
    ("Software", "Email/Calendar", "Outlook Issue", [
        "Outlook مش بيرد وكتير بيعمل Not Responding. جربت Repair ولسه المشكلة موجودة.",
        "الإيميلات بتتأخر توصل في Outlook بس بتكون موجودة على الويب. غالباً مشكلة Sync.",
    ]),
    ("Network", "Internet/LAN", "DNS", [
        "مش عارف أفتح المواقع بالاسم، لكن بالـ IP بيفتح. واضح إن في مشكلة DNS عندي أو في الشبكة.",
    ]),
]

# patterns for leaves without texts of their own
GENERIC_TITLE_ISSUE = "مشكلة في %s"
GENERIC_TITLE_REQUEST = "طلب متعلق بـ %s"
GENERIC_DESCRIPTION_CATEGORY = "فيه مشكلة مرتبطة بـ %s / %s / %s. الموضوع مأثر على الشغل ومحتاج يتحل بسرعة."
GENERIC_DESCRIPTION_AGE = "المشكلة مستمرة من يومين. جربت Restart وبرضه نفس الوضع. لو محتاجين لوجز أنا جاهز."
