"""Word lists, limits and selectors that results depend on."""

NO_RESULTS_PHRASES = [
    "no results", "no results found", "no result found", "0 results", "0 result", "no product", "nothing found",
    "did not find anything", "did not find anythings", "we did not find", "we did not find anything",
    "we did not find anythings", "try another search", "try a different search",
]
LINK_SCHEMES_REFUSED = ["javascript:", "mailto:", "tel:"]
LINK_KEYWORDS_REFUSED = [
    "login", "register", "signup", "account", "profile", "help", "faq", "contact", "privacy", "terms", "policy", "cart",
    "wishlist", "checkout", "track", "order", "facebook", "instagram", "whatsapp", "twitter", "youtube", "pinterest",
    "linkedin", "support", "mailto:", "tel:", "javascript:", "gift-card", "loyalty",
]
HOME_PATHS = ["", "/", "/home", "/index", "/index.html"]
PRODUCT_KEYWORDS = [
    "/product", "/products", "/item", "/items", "/p/", "/dp/", "/pd/", "/pdp", "/shop/", "/store/", "/catalog", "/listing",
    "/sku", "/detail", "/details", "/gp/", "/gp/product", "/listing/", "/prod", "/itm", "/itm/", "collection", "collections",
    "category", "categories", "productId", "sku=", "pid=", "variant=", "model=", "/buy/", "/sale/",
]
PATH_KEYWORDS_REFUSED = [
    "search", "account", "contact", "login", "register", "wishlist", "cart", "help", "support", "faq", "privacy", "terms",
]
NAV_WORDS = [
    "home", "about", "contact", "help", "account", "login", "register", "signup", "wishlist", "cart", "track", "order",
    "policy", "privacy", "terms", "faq", "support", "customer care", "service", "blog", "news", "store locator",
]
PRICE_TOKENS = ["$", "₹", "rs.", "rs ", "usd", "eur", "price"]
#: Tested in this order; the first that fits counts.
CURRENCIES = [("INR", ["₹", "rs", "inr"]), ("USD", ["$", "usd"]), ("EUR", ["€", "eur"]), ("GBP", ["£", "gbp"]), ("CAD", ["cad"]), ("AUD", ["aud"])]
PRICE_MARKERS = ["₹", "rs.", "rs", "inr", "usd", "eur", "cad", "aud", "£", "€", "$"]
IN_STOCK = ["in stock", "instock", "available"]
OUT_OF_STOCK = ["out of stock", "outofstock"]
PRODUCT_LIKE_KEYS = ["product", "item", "sku", "listing", "result", "entries", "records"]
SECTIONS_REFUSED = ["header", "nav", "footer", "aside", "form"]
SECTION_STEPS = 5  # ancestors looked at

MAX_ITEMS, WAIT_SECONDS, MAX_RETRIES = 50, 12, 3
QUEUE_STATUSES = ["pending", "retrying"]
OFFSET_ROWS = 10_000  # rows read from an offset where no limit is given
DESCRIPTION_CHARS, DESCRIPTION_LEAST, ERROR_CHARS, SCRIPT_CHARS = 400, 15, 500, 500_000
MOST_PRICE, MOST_RATING = 999999999.99, 100.0
GENERIC_DEPTH, SHALLOW_DEPTH = 6, 1

#: CSS selectors by group, the most telling first.
SELECTORS = {
    "result_containers": [
        "ul.products", "ul.product-list", "ul.search-results", "div.products", "div.product-list", "div.search-results",
        'div[class*="listing" i]', 'div[class*="product-grid" i]', 'div[data-component*="product" i]',
        'div[data-testid*="result" i]', 'section[class*="grid" i]', 'section[class*="listing" i]',
        'section[class*="catalog" i]', 'div[class*="grid" i]', 'section[class*="product" i]', 'section[class*="result" i]',
        "main",
    ],
    "product_cards": [
        '[data-component="product"]', '[data-qa*="product" i]', '[data-testid*="product" i]', '[data-cy*="product" i]',
        '[itemscope][itemtype*="schema.org/Product" i]', "div[data-product-id]", "article[data-product-id]",
        "div[data-asin]", "li[data-asin]", 'li[data-id*="product" i]', 'div[data-testid*="product-card" i]',
        'li[class*="product" i]', 'li[class*="grid" i]', 'div[class*="product" i]', 'div[class*="item" i]',
        'div[class*="card" i]', 'div[class*="result" i]', 'article[class*="product" i]', 'article[class*="item" i]',
    ],
    "title": [
        '[itemprop="name"]', "a[title]", 'a[class*="title" i]', 'a[data-testid*="title" i]', "h1", "h2", "h3", "h4",
        '[class*="title" i]', '[class*="name" i]', '[aria-label*="product" i]',
    ],
    "link": [
        'a[href*="/product" i]', 'a[href*="/item" i]', 'a[href*="/p/" i]', 'a[href*="?pid=" i]',
        'a[data-testid*="product" i]', 'a[data-track*="product" i]', "a[href]", '[itemprop="url"]',
    ],
    "image": [
        "img[src]", "img[data-src]", "img[data-original]", "img[data-lazy-src]", "img[data-srcset]", "source[data-srcset]",
        "[data-background-image]", '[itemprop="image"]',
    ],
    "price": [
        '[itemprop="price"]', '[class*="price" i]', '[class*="offer" i]', "[data-price]", "span[data-price]",
        "div[data-price]", 'span[class*="amount" i]', 'span[class*="value" i]', 'meta[itemprop="price"][content]',
    ],
    "currency": ['meta[itemprop="priceCurrency"][content]', '[class*="currency" i]', "span[data-currency]"],
    "rating": ['[itemprop="ratingValue"]', '[class*="rating" i]', '[aria-label*="rating" i]'],
    "reviews": ['[itemprop="reviewCount"]', '[class*="review" i]', '[aria-label*="review" i]'],
    "availability": ['[itemprop="availability"]', '[class*="stock" i]', '[class*="avail" i]'],
    "brand": ['[itemprop="brand"]', '[class*="brand" i]', "[data-brand]"],
    "sku": ['[itemprop="sku"]', "[data-sku]", "[data-product-sku]", '[class*="sku" i]'],
    "description": ['[itemprop="description"]', '[class*="description" i]', '[class*="subtitle" i]', "p"],
}
