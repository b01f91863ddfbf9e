"""Names, words, texts and formats that results must show exactly."""

# Instruments: name -> vendor symbol.
INSTRUMENTS = {
    "NSEI": "^NSEI",
    "NSEBANK": "^NSEBANK",
    "SNP": "^GSPC",
    "INDIA_VIX": "^INDIAVIX",
}
PRIMARY = "NSEI"

# Activity categories: category -> path of its records in the landed document.
SNAPSHOT_PATHS = {
    "Most Active by Value": "$.data",
    "Volume Gainers": "$.data",
    "Most Active by Volume": "$.data",
    "Top Gainers": "$.allSec.data",
    "Top Losers": "$.allSec.data",
}
# The one document that holds three categories: document -> {field: category}.
SPLIT_DOCUMENT = "Large Deals"
SPLIT_FIELDS = {
    "BULK_DEALS_DATA": "Bulk Deals Data",
    "BLOCK_DEALS_DATA": "Block Deals Data",
    "SHORT_DEALS_DATA": "Short Deals Data",
}
# Order of the categories in the activity table.
CATEGORY_ORDER = [
    "Most Active by Value",
    "Volume Gainers",
    "Most Active by Volume",
    "Top Gainers",
    "Top Losers",
    "Bulk Deals Data",
    "Block Deals Data",
    "Short Deals Data",
]
REASON_COLUMN = "Reason"
KEYS_COLUMN = "relavant_columns"

# Indices read by default.
INDICES = [
    "NIFTY 50", "NIFTY NEXT 50", "NIFTY 100", "NIFTY 200", "NIFTY 500",
    "NIFTY MIDCAP 50", "NIFTY MIDCAP 100", "NIFTY MIDCAP 150",
    "NIFTY SMALLCAP 50", "NIFTY SMALLCAP 100", "NIFTY SMALLCAP 250",
    "NIFTY BANK", "NIFTY IT", "NIFTY FMCG", "NIFTY PHARMA", "NIFTY AUTO",
    "NIFTY FINANCIAL SERVICES", "NIFTY ENERGY", "NIFTY METAL", "NIFTY REALTY",
]
INDEX_TYPE = "INDEX"
MID_PATTERN = "MIDCAP"
SMALL_PATTERN = "SMALLCAP"
CAP_COLUMN = "Market Cap Classification"
CAP_CLASSES = {"mid": "Mid Cap", "small": "Small Cap", "large": "Large Cap"}

# Headlines.
HEADLINE_TAG = "a"
HEADLINE_CLASS = "DY5T1d"
HEADLINE_LIMIT = 10
POSITIVE_WORDS = ["rally", "positive", "gain", "up", "surge", "buying"]
NEGATIVE_WORDS = ["fall", "crash", "down", "bearish", "sell-off", "decline"]

# Trend labels and bounds.
TREND_UP = "📈 Uptrend"
TREND_DOWN = "📉 Downtrend"
TREND_FLAT = "➡️ Sideways"
TREND_HIGH = 0.6
TREND_LOW = 0.4

# Alert styles: type -> icon, colour.
STYLES = {
    "info": ("ℹ️", "blue"),
    "success": ("✅", "green"),
    "warning": ("⚠️", "orange"),
    "error": ("❌", "red"),
    "alert": ("🚨", "red"),
    "profit": ("💰", "green"),
    "loss": ("📉", "red"),
    "trade": ("📊", "blue"),
}
DEFAULT_STYLE = "info"

# Cell markers used where a rule names none.
STRIKE_MARKERS = {"atm": "🎯", "itm": "🟡", "otm": "🔵"}
CHANGE_MARKERS = {"high_change": "⚡", "positive": "🟢", "negative": "🔴", "zero": "⚪"}
HIGH_CHANGE = 10.0

MESSAGE_LIMIT = 4096
PREVIEW_LENGTH = 50
TABLE_ROWS = 20
TABLE_RULE = "─" * 40
SYMBOL_LENGTH = 15
BATCH_LIMIT = 10

# Texts; names in braces are columns.
PREDICTION_MESSAGE = """\
<b>🤖 Hourly Market Prediction</b>
⏰ <i>{timestamp}</i>

<b>Next Hour Prediction:</b> {trend}
<b>Uptrend Probability:</b> {probability}
<b>Model Accuracy:</b> {accuracy}

<b>📊 Model Performance:</b>
• Precision (Down): {precision_0}
• Precision (Up): {precision_1}
• Recall (Down): {recall_0}
• Recall (Up): {recall_1}

<b>📈 Data Overview:</b>
• Data Points: {data_points} (1-min intervals)
• Features Used: {features_used}
• Timeframe: Last 7 days

<i>🔄(1-min data)</i>"""
ERROR_MESSAGE = """\
<b>🚨 Market Predictor Error</b>
⏰ <i>{timestamp}</i>

<b>Error:</b> {error}

<i>Please check the logs for more details.</i>"""
STATUS_MESSAGE = """\
📊 <b>Bot Status</b>

🟢 Status: Active
📱 Mode: On-demand checking
👥 Authorized Users: {authorized}
🔧 Commands: {commands}
📨 Last Update ID: {last_update_id}

<i>Bot ready for notifications!</i>"""
HELP_MESSAGE = '\n🆘 <b>Available Commands:</b>\n\n{commands}\n\n💡 <b>How it works:</b>\nThis bot checks for messages only when your trading script calls check_messages().\nSend notifications anytime with send_notification().\n        '
PING_TEXT = "🏓 Pong! Bot is responsive."
INFO_FALLBACK_TEXT = "❌ Could not retrieve bot information"
UNKNOWN_TEXT = "❓ Unknown command: /"
ERROR_TEXT = "❌ Error: "
FAILURE_TEXT = "🚨 Pipeline failed: "
DEFAULT_COMMANDS = ["status", "help", "ping", "info"]

# Features taken from each instrument: feature -> (instrument, column), in table order.
FEATURE_SOURCES = {
    "N_Close": ("NSEI", "close"),
    "N_Return": ("NSEI", "return"),
    "N_Return_1h": ("NSEI", "return_1h"),
    "B_Close": ("NSEBANK", "close"),
    "B_Return": ("NSEBANK", "return"),
    "B_Return_1h": ("NSEBANK", "return_1h"),
    "SNP_Return": ("SNP", "return"),
    "VIX_Close": ("INDIA_VIX", "close"),
    "VIX_Return": ("INDIA_VIX", "return"),
    "NSEI_RSI": ("NSEI", "rsi"),
    "NSEI_MACD": ("NSEI", "macd"),
    "NSEI_Volatility": ("NSEI", "volatility"),
    "NSEBANK_RSI": ("NSEBANK", "rsi"),
    "NSEBANK_MACD": ("NSEBANK", "macd"),
    "NSEBANK_Volatility": ("NSEBANK", "volatility"),
}

# Feature columns of the trend model, in order, by group.
BASE_FEATURES = [
    "N_Return", "N_Return_1h",
    "NSEI_RSI", "NSEI_MACD", "NSEI_Volatility",
    "Hour", "Minute", "DayOfWeek",
    "Sentiment",
]
# (column whose presence adds the group, columns of the group)
FEATURE_GROUPS = [
    ("B_Return", ["B_Return", "B_Return_1h"]),
    ("NSEBANK_RSI", ["NSEBANK_RSI", "NSEBANK_MACD", "NSEBANK_Volatility"]),
    ("SNP_Return", ["SNP_Return"]),
    ("VIX_Return", ["VIX_Close", "VIX_Return"]),
]
TARGET = "Target"
MIN_TRAINING_ROWS = 500
