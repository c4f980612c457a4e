"""Fixed values the recodes must reproduce exactly.

Everything in this module is a constant taken as-is from the behaviour being
reproduced (whitelists, bucket lists, labels, thresholds, date formats). They
are listed plainly and in their natural order; change them only together with
the expected results.
"""

# --- fixed values: identifiers -------------------------------------------------
SENTINEL_IDS = ("00000000-0000-0000-0000-000000000000", "0000-0000")

# --- fixed values: attribution events --------------------------------------------
INSTALL_EVENTS = ("install", "reinstall")
UNINSTALL_EVENTS = ("uninstall",)
LOGIN_EVENT = "af_login"
KEPT_GROUPINGS = ("Organico", "Install Aquisicao")
GROUPING_RENAMES = {"Install Aquisicao": "install_aquisicao"}
OTHER_LABEL = "Outros"
NULL_SOURCE_LABEL = "na"
MEDIA_SOURCES = (
    "restricted",
    "banner_home_app",
    "facebook ads",
    "googleadwords_int",
    "bytedanceglobal_int",
    "shareit_int",
)

# --- fixed values: day parts (hour ranges, lower inclusive) -----------------------
# name: (low, high, high_inclusive)
DAYPARTS = (
    ("install_manha", 6, 12, False),
    ("install_tarde", 12, 19, False),
    ("install_noite", 19, 23, True),
    ("install_madrugada", 0, 6, False),
)

# --- fixed values: age bands (upper bound inclusive) ----------------------------
AGE_BANDS = ((20, "ATE_20"), (30, "21_A_30"), (50, "31_A_50"))
AGE_BAND_ELSE = "+_50"
DAYS_PER_YEAR = 365.25

# --- fixed values: regions ----------------------------------------------------------
REGION_SUDESTE = ("State of Sao Paulo", "State of Rio de Janeiro", "State of Minas Gerais", "State of Espirito Santo")
REGION_SUL = ("State of Parana", "State of Rio Grande do Sul", "State of Santa Catarina")
REGION_NORTE = (
    "State of Acre",
    "State of Amapa",
    "State of Amazonas",
    "State of Para",
    "State of Rondonia",
    "State of Roraima",
    "State of Tocantins",
)
REGION_CENTRO_OESTE = ("Federal District", "State of Mato Grosso", "State of Goias", "State of Mato Grosso do Sul")
REGION_BUCKETS = (
    ("sudeste", REGION_SUDESTE),
    ("sul", REGION_SUL),
    ("norte", REGION_NORTE),
    ("centro_oeste", REGION_CENTRO_OESTE),
)
NORDESTE = "nordeste"
NORDESTE_PATTERN = "%State of"  # as written upstream; matches no real state name
NORDESTE_PATTERN_FIXED = "State of%"

# --- fixed values: hit dimensions and whitelists ------------------------------------
LOGIN_DIMENSION = 4
CUSTOMER_DIMENSION = 68
DEVICE_DIMENSION = 69
SCREEN_DIMENSION = 5
DEPARTMENT_DIMENSION = 6
LOGGED_IN_VALUE = "logado"

SCREEN_TEMPLATES = ("busca", "produto", "home", "conta", "colecao")
ACTION_EVENTS_V1 = (
    "produto_buscou_duvida",
    "produto_navegou",
    "acesso_clicou",
    "produto_calculou",
    "produto_clicou",
    "carrinho_calculou",
    "produto_favoritou",
    "optin-push-sys_clicou",
    "enhanced_ecommerce_add_to_cart",
    "enhanced_ecommerce_remove_from_cart",
    "enhanced_ecommerce_begin_checkout",
    "enhanced_ecommerce_checkout_progress",
    "compra finalizada_clicou",
)
ACTION_EVENTS_V2 = (
    "acesso_clicou_clicou talvez mais tarde",
    "produto_clicou_midia avaliacoes",
    "optin-push-sys_clicou_permitiu",
    "erro_exibiu_desculpe! no momento este produto nao pode ser entregue na regiao informada. (id-1200)",
    "acesso_clicou_senha",
    "acesso_clicou_entrar com facebook",
    "acesso_clicou_cadastro concluido",
    "acesso_clicou_ativou biometria",
)
CORE_PRODUCTS = ("moveis", "celulares e telefones", "eletrodomesticos", "portateis", "tv e video")
TAIL_PRODUCTS = (
    "utilidades domesticas",
    "esporte e lazer",
    "automotivo",
    "ar e ventilacao",
    "calcados",
    "informatica",
    "bebes",
    "ferramentas",
    "audio",
    "games",
    "saude e beleza",
    "acessorios e inovacoes",
    "perfumaria e cosmeticos",
)
CORE_LABEL = "core"
TAIL_LABEL = "calda"

# --- fixed values: action, sex and channel recodes ----------------------------------
DELIVERY_ERROR_EVENT = ACTION_EVENTS_V2[3]
DELIVERY_ERROR_LABEL = "erro_regiao_nao_entregue"
LOGIN_ACTIONS = (
    "acesso_clicou_senha",
    "acesso_clicou_entrar com facebook",
    "acesso_clicou_cadastro concluido",
    "acesso_clicou_ativou biometria",
)
LOGIN_ACTION_LABEL = "acesso_login_realizado"
MISSING_LABEL = "sem_info"
SEX_MALE = ("M", "m")
SEX_FEMALE = ("F", "f")

INSTALL_CHANNEL_PREFIX = "install : "
INSTALL_CHANNEL_PATTERN = "install :%"
DIRECT_LABEL = "Direto"
KEPT_CHANNELS = ("Direto", "CRM - Marketing Direto", "SEM - Shopping", "Remarketing")
OTHER_CHANNELS_LABEL = "outros_canais"

# --- fixed values: date and time formats ---------------------------------------------
HIT_DATE_FORMAT = "yyyyMMdd"
HIT_PARSE_FORMAT = "yyyy-MM-ddHHss"  # minute travels through the seconds slot
HIT_RENDER_FORMAT = "yyyy-MM-dd hh:ss"  # 12-hour clock: the AM/PM bit is lost
HIT_RENDER_FORMAT_EXACT = "yyyy-MM-dd HH:mm"

# --- fixed values: one-hot and model selection -----------------------------------------
ONEHOT_COLUMNS = (
    "faixa_etaria",
    "sexo",
    "screen_view",
    "produto_view",
    "action_event_v1",
    "action_event_v2",
    "regioes",
    "install_channel",
    "canais",
)
CORR_EXCLUDED_SUBSTRING = "install_channel"
CORR_THRESHOLD = 0.7
TRAIN_FRACTION_TENTHS = 7
